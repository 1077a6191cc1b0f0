import pytest

from tessella.llm.garbled import find_garbled, repair

TEXT = "若两个屏障的键相同，后到的那个会被离线类加载校准。"
GERMAN = "Für jede Schleife prüft das Übungsblatt größere Werte."


def wrong(text, written, read):
    return text.encode(written).decode(read, "replace")


@pytest.mark.parametrize("text, read", [(TEXT, "latin-1"), (GERMAN, "cp1252"), (GERMAN, "latin-1"), (TEXT, "mac_roman"), (GERMAN, "mac_roman"), (TEXT, "cp437"), ("“term” — l’été", "cp437")])
def test_utf8_read_otherwise_comes_back_whole(text, read):
    assert repair(wrong(text, "utf-8", read)) == (True, True, text)


def test_gbk_read_as_latin_and_mixed_text():
    assert repair("Before it " + wrong(TEXT, "gbk", "latin-1")) == (True, True, "Before it " + TEXT)
    part = "前面是好的，" + wrong("只读断言的名字", "utf-8", "gb18030")
    garbled, _, text = repair(part)
    assert garbled and text.startswith("前面是好的，只读断言的名")


def test_twice_garbled_text_is_undone_twice():
    twice = wrong(wrong(GERMAN, "utf-8", "latin-1"), "utf-8", "latin-1")
    assert repair(twice) == (True, True, GERMAN)


def test_lost_characters_are_found_but_not_restored():
    assert repair("这里锟斤拷锟斤拷坏了")[:2] == (True, False)
    assert repair("caf� au lait")[:2] == (True, False)


@pytest.mark.parametrize(
    "text",
    [None, "", "plain ascii", TEXT, GERMAN, "L'élève complète la méthode où ça va. «Été»", "¿Qué compiló? ½ ≠ ∑ √2", "한글 주석 カタカナ ｃｌａｓｓ　Ａ １２３", "👩🏽‍💻 🧪✅ 𝒳→𝒴 龘靐齉", "Seeing \"Â£\" on screen means the file was read with another encoding.", "编码课上的例子：“锟斤拷”就是读错编码后的样子。", "例子：“浣犲ソ”就是。", "‫אבג‬ étude"],
)
def test_proper_writing_and_quoted_examples_are_left(text):
    assert repair(text) == (False, False, text)


RUSSIAN = "Каждый узел дерева хранит ключ, и поиск начинается с корня."
KOREAN = "각 노드는 하나의 키를 가지고 있으며 검색은 루트에서 시작한다"
JAPANESE = "それぞれのノードはキーを一つ持ち、検索は根から始まります。"


@pytest.mark.parametrize(
    "text, written, read",
    [
        (RUSSIAN, "cp1251", "latin-1"),
        (RUSSIAN, "cp1251", "koi8_r"),
        (RUSSIAN, "koi8_r", "cp1251"),
        (RUSSIAN, "cp866", "cp1251"),
        (GERMAN, "utf-8", "cp1250"),
        (GERMAN, "utf-8", "iso8859_15"),
        ("über alles", "utf-8", "iso8859_15"),
        (TEXT, "gbk", "big5"),
        (JAPANESE, "cp932", "gbk"),
        (JAPANESE, "cp932", "latin-1"),
        (KOREAN, "euc_kr", "latin-1"),
    ],
)
def test_pairs_of_many_encodings(text, written, read):
    seen = text.encode(written).decode(read, "replace")
    garbled, restored, back = repair(seen)
    assert garbled
    # Either the text is back, or what is there is still what was seen where it couldn't be.
    assert back == text if restored else back != text


@pytest.mark.parametrize("text, written, read", [(RUSSIAN, "cp1251", "latin-1"), (RUSSIAN, "cp1251", "koi8_r"), (GERMAN, "utf-8", "cp1250"), ("über alles", "utf-8", "iso8859_15"), (KOREAN, "euc_kr", "latin-1")])
def test_these_come_back(text, written, read):
    assert repair(text.encode(written).decode(read)) == (True, True, text)


def test_many_rounds_and_long_quotations():
    seen = GERMAN
    for _ in range(4):
        seen = seen.encode("utf-8").decode("latin-1")
    assert repair(seen) == (True, True, GERMAN)
    quoted = f"So sieht das aus: “{wrong(GERMAN, 'utf-8', 'latin-1')}”, wenn man falsch liest."
    assert repair(quoted) == (False, False, quoted)


@pytest.mark.parametrize("text", [RUSSIAN, KOREAN, JAPANESE, RUSSIAN.upper(), "ПРИВЕТ мир", "Größe", "naïveté coöperation", "Łódź źdźbło żółć", "çığır açan şey", "ﾃｽﾄです", "臺灣與韓國的龘字", "±½°→≠∑√", "Ærø Ålesund øæå"])
def test_other_languages_are_left(text):
    assert repair(text) == (False, False, text)


def test_operator(spark):
    bad = wrong(GERMAN, "utf-8", "cp1252")
    df = spark.createDataFrame([(1, bad, "x"), (2, None, "x"), (3, "", "x"), (4, TEXT * 5000, "x"), (1, bad, "x")], "doc_id bigint, text string, garbled string")
    got = sorted((r.doc_id, r.garbled, r.restored) for r in find_garbled(df, "doc_id", "text").collect())
    assert got == [(1, True, True), (1, True, True), (2, False, False), (3, False, False), (4, False, False)]
    assert find_garbled(df.limit(0), "doc_id", "text").collect() == []
