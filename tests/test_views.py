import random

from pyspark.sql import functions as F

from tessella.operators import views


def test_trimming_covers_nodes_first(spark):
    rnd = random.Random(5)
    rows = [("v", f"e{i:03d}", f"n{rnd.randrange(12)}", f"n{rnd.randrange(12)}", rnd.choice(["part_of", "demonstrates", "other"]), round(rnd.random(), 3)) for i in range(60)] + [("w", "x", "a", "b", "part_of", 0.5)]
    df = spark.createDataFrame(rows, "view string, id string, source string, target string, type string, confidence double")
    order = {"part_of": 0, "demonstrates": 1}
    wanted = sorted((r for r in rows if r[0] == "v"), key=lambda r: (order.get(r[4], 9), -r[5], r[2], r[3], r[1]))
    chosen, seen = [], set()
    for r in wanted:
        if r[2] not in seen or r[3] not in seen:
            chosen.append(r[1])
            seen |= {r[2], r[3]}
    chosen += [r[1] for r in wanted if r[1] not in chosen][: 20 - len(chosen)]
    got = views.trimmed_edges(df, "view", most=20).collect()
    assert {r.id for r in got if r.view == "v"} == set(chosen) and [r.id for r in got if r.view == "w"] == ["x"]


def test_cyclic_part(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("x", "a"), ("c", "y"), ("p", "q"), ("s", "s"), ("c", "s"), ("c", "s")]
    got = views.cyclic_part(spark.createDataFrame(edges, "source string, target string"))
    assert {tuple(r) for r in got.collect()} == {("a", "b"), ("b", "c"), ("c", "a"), ("c", "s"), ("s", "s")}
    assert views.cyclic_part(spark.createDataFrame([("a", "b")], "source string, target string")).collect() == []


def test_blocks_and_json(spark):
    df = spark.createDataFrame([("k", "intro\n1. one\nmore\n\n（2）two"), ("n", None)], "k string, t string")
    texts = spark.createDataFrame([('```json\n{"a": 1}\n```',), ('say {"b": [2]} end',), ("{bad",), (None,), ("",)], "t string")
    assert [r.j for r in texts.select(views.json_object(F.col("t")).alias("j")).collect()] == ['{"a": 1}', '{"b": [2]}', None, None, None]


def test_repaired_keeps_edges_of_every_type(spark, tmp_path):
    from tessella.plans.view_queries import g13_repaired

    nodes = [(i, i, "n", "KnowledgePoint", None, 0.9) for i in ("a", "b")]
    spark.createDataFrame([(k, *n[1:]) for k, n in enumerate(nodes)], "row_id bigint, id string, name string, type string, description string, confidence double").write.parquet(f"{tmp_path}/standard_nodes.parquet")
    kinds = ["has_code_structure", "expresses_concept", None, "may_cause"]
    spark.createDataFrame([(k, f"e{k}", "a", "b", t, 0.9, None) for k, t in enumerate(kinds)], "row_id bigint, id string, source string, target string, type string, confidence double, evidence string").write.parquet(f"{tmp_path}/standard_edges.parquet")
    got = sorted(map(tuple, g13_repaired(spark, str(tmp_path)).collect()), key=str)
    assert got == [("a", "may_cause", "b"), ("a", "part_of", "b"), ("a", None, "b"), ("b", "part_of", "a")]
