from pyspark.sql import functions as F

from tessella.llm.survivors import FieldRule, consensus, consensus_value, elect, is_placeholder, known_sources, source_list, tokens_of, trust_rank

SCHEMA = "row_id bigint, id string, name string, confidence double, origin string, updated_at timestamp, grp_key string, low int"


def rows(spark, *data):
    from datetime import datetime

    fix = lambda t: None if t is None else datetime(2026, 1, t)
    return spark.createDataFrame([(r, i, n, c, o, fix(t), "clash", 0) for r, i, n, c, o, t in data], SCHEMA)


def survivors(df, **k):
    rules = [FieldRule("name", F.col("name"), ~is_placeholder(F.col("name")), (trust_rank(F.col("origin")),)), FieldRule("confidence", F.col("confidence").cast("string"), (F.col("confidence") > 0) & (F.col("confidence") <= 1))]
    return {(r.grp_key, r.field_name): r.row_id for r in elect(df, F.lower(F.trim("id")), "row_id", "updated_at", rules, **k).collect()}


def test_rules_ties_and_placeholders(spark):
    df = rows(
        spark,
        (1, "A", "first", 0.5, "llm", 3),
        (2, " a", "second", float("nan"), "curated", None),
        (3, "a ", "　Unknown ", 2.0, "curated", 9),
        (4, "b", "alone", 0.5, "rule", 1),
        (4, "b", "alone", 0.5, "rule", 1),
        (5, "c", None, 0.0, None, None),
        (6, "c", "-", None, None, None),
        (8, "d", "x", 0.1, "odd", None),
        (7, "d", "y", 0.9, None, None),
        (9, None, "z", 0.9, None, None),
    )
    assert survivors(df) == {("a", "name"): 2, ("a", "confidence"): 1, ("d", "name"): 7, ("d", "confidence"): 7}
    assert survivors(df.limit(0)) == {}


def test_election_gives_the_best_ranked_row_of_every_group(spark):
    import random

    rnd = random.Random(5)
    names = ["index tree", "index  tree", "Index tree of keys", "B-tree", "索引树", "索引 树", "n/a", None]
    data = [(i, f"g{rnd.randrange(30)}" if i % 3 else "hot", rnd.choice(names) if i % 3 else f"name {rnd.randrange(90)} x", rnd.choice([None, 0.3, 0.9, 2.0]), rnd.choice(["curated", "rule", None]), rnd.choice([None, 1, 5, 9])) for i in range(400)]
    origin = {"curated": 0, "rule": 1, None: 4}
    want = {}
    for r, i, n, c, o, t in data:
        late = -(t or 0)
        for field, ok, rank in (("name", n not in (None, "n/a"), (origin[o], late, r)), ("confidence", c in (0.3, 0.9), (late, r))):
            if ok:
                want[i, field] = min(want.get((i, field), (rank,)), (rank,))
    want = {k: v[0][-1] for k, v in want.items()}
    df = rows(spark, *data)
    assert survivors(df) == want
    assert survivors(df, most_distinct=8, fan_in=2) == want


def test_sources_are_voted_on_member_by_member(spark):
    kind = "array<struct<chunk_id:string,source_file:string,page:int>>"
    df = spark.createDataFrame([([("c", "f", 1), ("a", "f", 2), ("c", "f", 1), (None, "f", 2)],)], f"s {kind}")
    assert len(tokens_of(df.select(source_list(F.col("s"))).first()[0])) == 2


def test_known_sources(spark):
    kind = "array<struct<chunk_id:string,source_file:string,page:int>>"
    df = spark.createDataFrame([([("c", "f", 1), ("c", "f", 1), (None, "f", 2), ("c", "f", None)],), ([],), (None,)], f"s {kind}")
    assert [r.n for r in df.select(known_sources(F.col("s")).alias("n")).collect()] == [2, 0, 0]


def test_consensus_picks_the_value_nearest_to_all():
    assert consensus_value([("red fox jumps", 1.0), ("red fox jumped", 1.0), ("red fox jumps high", 1.0)]) == "red fox jumps"
    assert consensus_value([("abc", 0.2), ("xyz", 0.9)]) == "xyz"
    assert consensus_value([("b", 0.5), ("a", 0.5)]) == "a"


def test_consensus_operator(spark):
    data = [("g", "索引树", 0.9), ("g", "索引树", 0.8), ("g", "索引数", 0.7), ("h", None, 0.5), ("h", "n/a", 0.5), ("i", "only", None), (None, "x", 0.5)]
    df = spark.createDataFrame(data, "k string, v string, c double")
    got = {r.grp_key: (r.n_rows, r.n_values, r.survivor) for r in consensus(df, F.col("k"), F.col("v"), F.col("c")).collect()}
    assert got == {"g": (3, 2, "索引树"), "i": (1, 1, "only")}
    many = spark.createDataFrame([("big", f"value number {i % 40}", 0.5) for i in range(90)], "k string, v string, c double")
    (row,) = consensus(many, F.col("k"), F.col("v"), F.col("c"), most_distinct=8).collect()
    assert row.n_values == 40 and row.survivor.startswith("value number")
    assert consensus(df.limit(0), F.col("k"), F.col("v"), F.col("c")).collect() == []


def test_large_group_changes_no_other_and_keeps_its_nearest_value(spark):
    small = {f"s{g}": [(f"red {a} jumps {b}", w) for a, b, w in [("fox", "high", 0.4), ("fox", "low", 0.3), ("cat", "low", 0.3), (f"dog{g}", "high", 0.2)]] for g in range(20)}
    big = [(f"note {chr(97 + i // 26)}{chr(97 + i % 26)} on old maps", 0.5) for i in range(59)] + [("note on old maps", 0.05)]
    rows = [(k, v, w) for k, values in {**small, "big": big}.items() for v, w in values]
    df = spark.createDataFrame(rows, "k string, v string, c double")
    got = {r.grp_key: r.survivor for r in consensus(df, F.col("k"), F.col("v"), F.col("c"), most_distinct=4).collect()}
    assert {k: got[k] for k in small} == {k: consensus_value(v) for k, v in small.items()}
    assert len(got) == 21 and got["big"] == consensus_value(big)


def test_blocks_of_a_large_group_vote_with_all_their_tokens(spark):
    # Each word position has its own majority; the one value that writes them all is the lightest of all.
    words = "a b c d e f g h".split()
    big = [(" ".join(f"x{i}" if k == i % 8 else w for k, w in enumerate(words)), 0.5) for i in range(64)] + [(" ".join(words), 0.01)]
    df = spark.createDataFrame([("big", v, w) for v, w in big], "k string, v string, c double")
    for most in (4, 16, 32):
        assert consensus(df, F.col("k"), F.col("v"), F.col("c"), most_distinct=most).first().survivor == "a b c d e f g h"
