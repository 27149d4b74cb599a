"""Pages in code pages that nothing tells: each is read as it was written."""

import pytest
from pyspark.sql import functions as F

from tidewire.functions.encodings import CODE_PAGES, likeliest
from tidewire.operators import parse

TEXTS = {
    "french": "Le président a déclaré que la réforme des retraites sera présentée à l'été, après le débat où chaque élève pourra s'exprimer.",
    "german": "Die Bürgermeisterin erklärte, dass die Straße über den Fluss für größere Fahrzeuge geschlossen bleibt. Schöne Grüße aus München.",
    "spanish": "El niño cantó una canción en español mientras la señora preparaba el café. ¿Qué pasará mañana con la situación económica?",
    "polish": "Wczoraj wieczorem prezydent ogłosił, że będzie ubiegał się o reelekcję. Żółw i gęś poszły łąką w stronę źródła, aby się napić.",
    "czech": "Včera večer přišel ředitel školy a řekl, že žáci můžou jít domů dříve. Příští týden bude pršet a teplota klesne.",
    "turkish": "Başbakan dün akşam yaptığı açıklamada, ülkenin geleceği için önemli değişiklikler yapılacağını söyledi. Çocuklar okula gidiyor.",
    "russian": "Вчера вечером президент заявил, что новые правила вступят в силу в следующем году. Жители города ждут перемен.",
    "greek": "Ο πρόεδρος δήλωσε χθες το βράδυ ότι η νέα πολιτική θα ξεκινήσει την επόμενη εβδομάδα στην Αθήνα.",
    "hebrew": "ראש הממשלה הודיע אתמול כי הממשלה תדון בתקציב החדש בשבוע הבא בירושלים.",
    "arabic": "أعلن الرئيس أمس أن الحكومة ستبدأ تنفيذ الخطة الجديدة في الأسبوع المقبل في العاصمة.",
    "thai": "นายกรัฐมนตรีกล่าวเมื่อวานนี้ว่ารัฐบาลจะเริ่มดำเนินการตามแผนใหม่ในสัปดาห์หน้า",
    "japanese": "昨日の夜、首相は新しい政策について記者会見を開き、来年から実施すると発表しました。東京の天気は晴れです。",
    "chinese": "昨天晚上，总理在北京宣布，新的政策将从明年开始实行。这是我们国家的一个重要的决定，人们都在等着他的说法。",
    "taiwanese": "昨天晚上，總統在台北宣布，新的政策將從明年開始實行。這是我們國家的一個重要的決定，人們都在等著他的說法。",
    "korean": "어제 저녁 대통령은 새로운 정책이 내년부터 시행될 것이라고 발표했다. 서울의 날씨는 맑고 따뜻하다.",
}
PAGES = [
    ("french", "cp1252"), ("german", "cp1252"), ("spanish", "cp1252"), ("polish", "cp1250"), ("czech", "cp1250"), ("turkish", "cp1254"), ("russian", "cp1251"), ("russian", "koi8_r"),
    ("russian", "iso8859_5"), ("russian", "cp866"), ("greek", "cp1253"), ("hebrew", "cp1255"), ("arabic", "cp1256"), ("thai", "cp874"), ("japanese", "shift_jis"), ("japanese", "euc_jp"),
    ("chinese", "gb18030"), ("taiwanese", "big5"), ("korean", "euc_kr"),
]


@pytest.mark.parametrize("language,page", PAGES)
def test_a_sentence_tells(language, page):
    body = f"<html><head><title>News of the day</title></head><body><p>{TEXTS[language]}</p><a href=/more>More news</a></body></html>".encode(page)
    assert body.decode(likeliest(body)) == body.decode(page)


def test_pages_through_the_operator(spark):
    rows = [(k, f"<p>{TEXTS[lang]}</p>", bytearray(f"<p>{TEXTS[lang]}</p>".encode(page))) for k, (lang, page) in enumerate(PAGES)]
    rows += [(100, "<p>é</p>", bytearray("<p>é</p>".encode())), (101, "plain", bytearray(b"plain")), (102, "", bytearray(b"")), (103, None, None)]
    df = spark.createDataFrame(rows, "k int, want string, html binary").withColumns({c: F.lit(None).cast("string") for c in ("raw_encoding", "http_encoding")})
    got = parse.decode_html(df).collect()
    assert not [r["k"] for r in got if r["text"] != r["want"]]
    assert {r["k"]: r["disposition"] for r in got if r["k"] >= 100} == {100: "decoded", 101: "decoded", 102: "no-html", 103: "no-html"}


def test_bytes_of_no_text():
    assert likeliest(b"plain ASCII") == likeliest(b"") == "cp1252"
    assert likeliest(b"\xff\xfe\x81\x8d\x8f\x90\x9d\xff") in (None, *(name for name, *_ in CODE_PAGES))
