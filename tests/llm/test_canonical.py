import pytest

from tessella.llm.canonical import CanonicalList, learn_fillers, link_mentions, osa, simplified_forms, words_of

ENTRIES = [("E1", "级联惰性拦截器", ["exact bounded machine", "EBM-143"]), ("E2", "惰性短路队列", ["lazy silent queue"]), ("E3", "双向短路反射口", []), ("R", "总目", None)]
WORDS = "级联 惰性 拦截器 短路 队列 双向 反射口 exact bounded machine lazy silent queue guarded".split()
LIST = CanonicalList(ENTRIES, WORDS, {ord(a): b for a, b in ("級级", "聯联", "攔拦")}, frozenset("of about kind".split()))


@pytest.mark.parametrize(
    "value, want",
    [
        ("级联惰性拦截器", "E1"),
        ("《級聯惰性攔截器》", "E1"),
        ("拦截器（级联惰性）", "E1"),
        ("惰性级联拦截器", "E1"),
        ("3.2 级联惰性拦截器 简介", "E1"),
        ("级联惰性拦器截", "E1"),
        ("级联惰学拦截器", "E1"),
        ("级联拦截器", ""),
        ("级联惰性队列", ""),
        ("exactBoundedMachine", "E1"),
        ("ＥＸＡＣＴ　ｂｏｕｎｄｅｄ machine", "E1"),
        ("machine of exact bounded kind", "E1"),
        ("about exact bounded machines", "E1"),
        ("exhact buonded machine", "E1"),
        ("exactb ounded machine", "E1"),
        ("exact guarded machine", ""),
        ("ebm143", "E1"),
        ("lazy queue", ""),
        ("", ""),
        ("？！", ""),
        ("x" * 100_000, ""),
    ],
)
def test_lookup(value, want):
    assert LIST.lookup(value) == want


def test_pieces():
    assert words_of("﻿Snake_case-Name　x​") == ["snake", "case", "name", "x"]
    assert osa("abcd", "abdc", 2) == 1 and osa("abc", "xyz", 1) == 2


def test_operator(spark):
    catalog = spark.createDataFrame([(i, n, a, 1) for i, n, a in ENTRIES], "id string, name string, aliases array<string>, mention_id int")
    words = spark.createDataFrame([(w,) for w in WORDS] + [(None,)], "term string")
    mentions = spark.createDataFrame([(1, "级联惰性拦截器", "x"), (1, "级联惰性拦截器", "x"), (2, None, "x"), (3, "　 ", "x"), (4, "别的", "x"), (5, "", "x")], "mention_id bigint, name string, id string")
    assert {tuple(r) for r in link_mentions(mentions, "mention_id", "name", catalog, words).collect()} == {(1, "E1"), (4, "")}
    assert {tuple(r) for r in link_mentions(mentions, "mention_id", "name", catalog.limit(0)).collect()} == {(1, ""), (4, "")}
    assert link_mentions(mentions.limit(0), "mention_id", "name", catalog, words).collect() == []
    with pytest.raises(ValueError):
        link_mentions(mentions, "mention_id", "name", catalog, words, most_terms=2)


@pytest.mark.parametrize("value, want", [("ratio", ""), ("radio", ""), ("offset", ""), ("audio settings", ""), ("classification", ""), ("file IO", "I"), ("the set", "S"), ("class of 3", "C"), ("ebl-144", ""), ("AGX-498", "A")])
def test_latin_mentions_are_whole_words(value, want):
    assert CanonicalList([("I", "IO", []), ("S", "Set", []), ("C", "类别", ["class"]), ("A", "别名", ["AGA-498"])], []).lookup(value) == want


def test_mentions_do_not_overlap():
    tool = CanonicalList([("1", "index tree", []), ("2", "tree of keys", []), ("3", "keys", [])], [])
    assert [m[2] for m in tool.mentions(["index", "tree", "of", "keys"])] == ["treeofkeys"]
    assert [m[2] for m in tool.mentions(["index", "tree", "and", "keys"])] == ["indextree", "keys"]


def test_shards_give_what_the_whole_list_gives(spark):
    import random

    rnd = random.Random(4)
    words = [f"{a}{b}" for a in ("lor", "mip", "zed", "tak", "gun") for b in ("an", "elo", "iru")]
    entries = [(f"e{i:02d}", " ".join(rnd.sample(words, 3)), [f"K{i}-{rnd.randrange(900)}"]) for i in range(40)]
    catalog = spark.createDataFrame(entries, "id string, name string, aliases array<string>")
    dictionary = spark.createDataFrame([(w,) for w in words], "term string")
    values = []
    for _, name, (alias,) in entries:
        w = name.split()
        values += [name, " ".join(reversed(w)), f"about {name}", name.replace("a", "e", 1), name[:-1], f"{alias} x", w[0]]
    mentions = spark.createDataFrame(list(enumerate(values)), "mention_id bigint, name string")
    link = lambda k: {tuple(r) for r in link_mentions(mentions, "mention_id", "name", catalog, dictionary, shard_entries=k).collect()}
    assert link(7) == link(1000)


def test_fillers_are_learned(spark):
    entries = [(f"e{i}", f"{a} {b}", []) for i, (a, b) in enumerate([("red", "machine"), ("blue", "tree"), ("green", "queue")])]
    values = spark.createDataFrame([(f"overview of {n}s {n}",) for _, n, _ in entries] + [("strange red machine",), ("known blue tree known green queue",)], "value string")
    assert learn_fillers(values, [entries], ["known"], {}, partners=5) == {"overview", "of"}


def test_table_of_traditional_characters(spark):
    table = simplified_forms(spark)
    assert len(table) > 2000 and "級聯".translate(table) == "级联"
