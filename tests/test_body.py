"""Body text of pages: menus without nav tags go, links within sentences stay."""

from tidewire.operators.parse import body_text

MENU = "".join(f'<li><a href="/{i}">Section {i}</a></li>' for i in range(6))
STORY = "<p>The council met on <a href=/x>Monday evening</a> to settle the budget of the coming year.</p><p>It took four hours.</p>"
WANT = "The council met on Monday evening to settle the budget of the coming year.\nIt took four hours."


def test_menus_without_nav_tags():
    assert body_text(f"<html><body><div><ul>{MENU}</ul></div><div>{STORY}</div><div><a href=/1>Home</a> | <a href=/2>About us</a></div></body></html>") == WANT


def test_lists_of_other_stories():
    more = "".join(f"<p><a href=/{i}>Another story that has a headline of some words number {i}</a></p>" for i in range(5))
    assert body_text(f"<body>{STORY}{more}</body>") == WANT


def test_an_article_element_wins_and_loses_its_menus_too():
    page = f"<body><div>Some other text of the page.</div><article><ul>{MENU}</ul>{STORY}</article></body>"
    assert body_text(page) == WANT


def test_a_list_of_plain_items_and_a_long_linked_paragraph_stay():
    long = " ".join(f"word{i}" for i in range(40))
    assert body_text(f"<body><ul><li>one</li><li>two</li></ul><p><a href=/x>{long}</a></p></body>") == f"one\ntwo\n{long}"


def test_pages_of_links_alone_and_odd_ones():
    assert body_text(f"<body><ul>{MENU}</ul></body>") == "\n".join(f"Section {i}" for i in range(6))
    assert body_text(None) is None and body_text("") == "" and body_text("<p>no body tag</p>") == ""
    assert body_text("<body><nav>skip</nav><p>a  b<br>c</p><script>x()</script></body>") == "a b\nc"
    assert body_text("<body><a href=/x>never closed<p>text of the page that follows it</body>") == "never closed\ntext of the page that follows it"
