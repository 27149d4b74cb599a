"""Which code page the bytes of a page are likeliest in, when nothing tells."""

from __future__ import annotations

import re

# For each code page, the letters of its languages beyond ASCII, and the ten or so commonest of them.
_LATIN = "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœšžÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝŒŠŽ"
_MIDDLE = "áâăäąćčçďéęëěíîĺľłńňóôőöŕřśšşťţúůűüýźžżßđÁÂĂÄĄĆČÇĎÉĘËĚÍÎĹĽŁŃŇÓÔŐÖŔŘŚŠŞŤŢÚŮŰÜÝŹŽŻĐ"
_TURKISH = "çğıöşüâîûÇĞİÖŞÜÂÎÛ"
_CYRILLIC = "А-Яа-яЁёІіЇїЄєҐґЎў"
CODE_PAGES = (
    ("cp1252", _LATIN, "éèàçêôâîäöüßñóíáúãõåøæ"),
    ("cp1250", _MIDDLE, "ąćęłńóśźżáčéěířšůúýžăâîșțőűöü"),
    ("cp1254", _TURKISH, "çğıöşü"),
    ("cp1251", _CYRILLIC, "оеаинтсрвл"),
    ("koi8_r", _CYRILLIC, "оеаинтсрвл"),
    ("iso8859_5", _CYRILLIC, "оеаинтсрвл"),
    ("cp866", _CYRILLIC, "оеаинтсрвл"),
    ("cp1253", "Ά-ώ", "αοιετσνηυρς"),
    ("cp1255", "ְ-ת", "יוהלאתרבשמ"),
    ("cp1256", "ء-ْ", "اليمنوترةبعد"),
    ("cp874", "ก-๛", "านรอกเงมยลว่้"),
    ("shift_jis", "ぁ-ヿ一-鿿々", "のにはをたがでてとしれいなるすん"),
    ("euc_jp", "ぁ-ヿ一-鿿々", "のにはをたがでてとしれいなるすん"),
    ("gb18030", "一-鿿", "的一是不了在人有我他这中大来上国个到说们为子和你地出道也时年"),
    ("big5", "一-鿿", "的一是不了在人有我他這中大來上國個到說們為子和你地出道也時年"),
    ("euc_kr", "가-힣", "이다는에의을가한고하은지로도를"),
)
#: Signs that stand in texts of any language.
_SIGNS = " «»„“”‘’‚–—…•·°§©®™€£№¿¡　-〿＀-￯"
_LOWER, _UPPER = "ß-öø-ÿœšžąćęłńśźżăčďěňřťůőűğışа-яёіїєґўά-ώ", "À-ÖØ-ÞŒŠŽĄĆĘŁŃŚŹŻĂČĎĚŇŘŤŮŐŰĞİŞА-ЯЁІЇЄҐЎΆ-Ϋ"
_OTHER, _CASE = re.compile(f"[^\\x00-\\x7f{_SIGNS}]"), re.compile(f"[a-z{_LOWER}][{_UPPER}]")
_RULES = [(name, *(re.compile(p) for p in (f"[{own}]", f"[^\\x00-\\x7f{own}{_SIGNS}]", f"[{common}]", f"[A-Za-z](?=[{own}])|[{own}](?=[A-Za-z])", f"[{own}](?=[{own}])"))) for name, own, common in CODE_PAGES]
LATIN_PAGES = ("cp1252", "cp1250", "cp1254")


def _score(text: str, name: str, own: re.Pattern, odd: re.Pattern, common: re.Pattern, mixed: re.Pattern, beside: re.Pattern) -> float:
    """High where the characters beyond ASCII are letters of one script, many of them common ones; low where they
    are odd signs, where capitals follow small letters, and where letters stand by the wrong neighbours: those
    beyond ASCII by each other in Latin script, by ASCII ones in all others."""
    n = max(1, len(_OTHER.findall(text)))
    wrong = beside if name in LATIN_PAGES else mixed
    gain = len(own.findall(text)) + 2 * len(common.findall(text))
    return (gain - 3 * len(odd.findall(text)) - 3 * len(_CASE.findall(text)) - 2 * len(wrong.findall(text))) / n


#: Texts that no code page reads at least this well are taken for cp1252, if they can be that.
LEAST = 1.1


def likeliest(body: bytes) -> str | None:
    """The code page that the whole of a text reads best in, of those that can decode it; the first of equals. Bytes
    below 0x80 tell nothing; None if no code page fits."""
    best, found, plain = LEAST, None, None
    for name, *rules in _RULES:
        try:
            text = body.decode(name)
        except ValueError:
            continue
        plain = plain or (name if name == CODE_PAGES[0][0] else None)
        score = _score(text, name, *rules)
        if score > best:
            best, found = score, name
    return found or plain
