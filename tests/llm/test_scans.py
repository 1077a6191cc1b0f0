from pyspark.sql import functions as F

import pytest

from tessella.llm.scans import Blanks, Decoder, Knowledge, learn, page_lines, paragraphs, repair_scans, scan_items, scan_noise
from tessella.runtime import Scratch

WORDS = ["矩阵块", "位图", "观察链", "排序", "编写组", "while", "names", "before", "pointer", "symbol", "algorithm", "sorting", "index", "tree", "for", "back"]
KNOWN = Knowledge(WORDS, {"决": ["块"], "泣": ["位"], "囹": ["图"], "0": ["o"], "vv": ["w"], "rn": ["m"]})


@pytest.mark.parametrize(
    "stream, want",
    [
        ("把矩阵决与泣图相连，解决了", ("把矩阵块与位图相连，解决了", 2, 0)),
        ("vvhile it narnes a p0inter", ("while it names a pointer", 3, 0)),
        ("nothing wrong 位图", ("nothing wrong 位图", 0, 0)),
        ("beforesymbol", ("before symbol", 0, 0)),
        ("indextree", ("index tree", 0, 0)),
        ("indexTree indexer", ("indexTree indexer", 0, 0)),
        ("an algo rithm, sort ing", ("an algorithm, sorting", 0, 0)),
        ("f0r x", ("for x", 1, 0)),
        ("排 序与位\n图 相连", ("排序与位图 相连", 0, 0)),
        ("a point-\ner is\ncopied¬\nback", ("a pointer is copiedback", 0, 2)),
        ("before-\nback", ("before-back", 0, 0)),
        ("5 -\nx", ("5 - x", 0, 0)),
        ("algo-\nrithm p0in-\nter", ("algorithm pointer", 1, 2)),
        ("", ("", 0, 0)),
    ],
)
def test_decoder(stream, want):
    assert Decoder(KNOWN).decode(stream) == want


def test_decoder_without_words():
    assert Decoder(Knowledge([])).decode("任何 text") == ("任何 text", 0, 0)


def test_lines():
    lines, numbers, edge = page_lines("标题\n正文\r\n第十六页\n")
    assert numbers == [2] and edge == [0, 1]
    assert page_lines("第 3 页")[1] == []
    assert page_lines("")[1:] == ([], [])


def test_look_alikes_and_running_words_are_learned(spark):
    scans = [(f"p{i}", f"f{i % 4}", "课程名", ("课程名（内部教材）" if i % 7 else "课程名（丙部教材）") + "\n这里的矩阵" + ("决" if i % 3 else "块") + "很大，解决了narnes。\n" + ("丙部位图" if i % 2 else "内部位图"), "pdf") for i in range(30)]
    clean = [(f"q{i}", "g", "课程名", "这里的矩阵块很大，解决了names，内部位图", "txt") for i in range(30)]
    df = spark.createDataFrame(scans + clean, "k string, f string, t string, x string, s string")
    items = scan_items(df, F.col("k"), F.col("x"), F.col("f"), F.col("t"), "raw", F.col("s") == "pdf")
    words = ["矩阵块", "位图", "names", "内部"]
    found = learn(items, words, Scratch(spark, "t"))
    assert found.shown == {"决": ["块"], "丙": ["内"], "rn": ["m"]}
    assert found.words == sorted([*words, "内部教材"])
    assert learn(items.limit(0), words, Scratch(spark, "t")) == Knowledge(sorted(words), {})


def test_blanks():
    tool = Blanks(["矩阵块", "位图", "names"])
    assert tool.hanzi("矩阵决，位图。地图") == ({("矩阵*", "决"): 1, ("*图", "地"): 1}, 1)
    assert tool.letters("narnes names nam3s") == ({("na*es", "rn"): 1, ("nam*s", "3"): 1}, 1)


def test_paragraphs_end_at_short_lines_that_end_a_sentence():
    assert paragraphs(["这是很长很长很长很长的一行", "接着写完。", "新的一段又是很长很长的一行", "到此为止"]) == [["这是很长很长很长很长的一行", "接着写完。"], ["新的一段又是很长很长的一行", "到此为止"]]
    assert paragraphs([" ", ""]) == []


def pages(spark):
    data = [
        ("p1", "f", "课程名", "课程名（内部教材）\n这里的矩阵\n决很大。\n第 3 页", "pdf"),
        ("p2", "f", None, "an symb-\nol here\n课程名（内部教材）", "pdf"),
        ("p2", "f", None, "an symb-\nol here\n课程名（内部教材）", "pdf"),
        ("p3", "f", "课程名", "正文第一行\n没有别的", "pdf"),
        ("p4", "g", "另一门", "另一门（内部教材）\n只有一页", "pdf"),
        ("p5", "f", "课程名", None, "pdf"),
        ("p6", "f", "课程名", "", "pdf"),
        ("p7", "f", "课程名", "矩阵决\n7", "txt"),
        ("p8", None, None, "泣图。" * 20_000, "pdf"),
    ]
    df = spark.createDataFrame(data, "k string, f string, t string, x string, s string").withColumn("noise", F.lit("clash"))
    return scan_items(df, F.col("k"), F.col("x"), F.col("f"), F.col("t"), "raw", F.col("s") == "pdf")


def test_noise(spark):
    got = {(r.item_key, r.noise) for r in scan_noise(pages(spark), WORDS, Scratch(spark, "t"), KNOWN).collect()}
    assert got == {("p1", "running"), ("p1", "misread"), ("p1", "pageno"), ("p2", "hyphen"), ("p2", "running"), ("p8", "misread")}
    assert scan_noise(pages(spark).limit(0), WORDS, Scratch(spark, "t")).collect() == []


def test_repair(spark):
    got = {r.item_key: r.text for r in repair_scans(pages(spark), WORDS, Scratch(spark, "t"), KNOWN).collect()}
    assert got["p1"] == "这里的矩阵块很大。" and got["p2"] == "an symbol here"
    assert got["p4"].startswith("另一门（内部教材）") and got["p8"] == "位图。" * 20_000
