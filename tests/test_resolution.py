"""Merge links of all kinds and what merging keeps."""

from pyspark.sql import functions as F

from tessella.operators import graph as g
from tessella.operators import resolution as r

SRC = "struct<chunk_id:string,source_file:string,page:int>"


def entities(spark):
    rows = [("e1", "Heap", "T", "short", 0.9), ("e2", "heap.", "T", "the longest", 0.5), ("e3", "Binary heap", "T", None, 0.4), ("e4", "Pile", "U", "  ", 0.8), ("e5", "Stack", "T", None, 0.7), ("e6", "LIFO", "T", None, 0.6), ("e7", "Queue", "T", None, 0.6)]
    return spark.createDataFrame(rows, "raw_id string, name string, type string, description string, confidence double").withColumn("ingested_at", F.lit(None).cast("timestamp"))


def links(spark):
    matches = spark.createDataFrame([("e3", "e1", "same"), ("e4", "e3", "same"), ("e7", "e1", "different"), ("e7", "e7", "same"), ("e7", "gone", "same"), (None, "e7", "same"), ("e7", "e5", None)], "left_id string, right_id string, verdict string")
    node = "row_id bigint, id string, name string, type string, description string, confidence double, original_entity_ids array<string>"
    nodes = spark.createDataFrame([(1, "S ", "s", "T", None, 0.9, ["e5", None, "gone"]), (2, "l", "l", "T", None, 0.9, ["e6"]), (3, "q", "q", "T", None, 0.9, ["e7"]), (4, "u", "u", "U", None, 0.9, ["e4"]), (5, "x", "x", "T", None, 0.9, None)], node)
    edge = "row_id bigint, id string, source string, type string, target string, confidence double, evidence string"
    pairs = [("s", "equivalent_to", "L", 0.95), ("s", "equivalent_to", "q", 0.89), ("q", "equivalent_to", "u", 0.99), ("q", "part_of", "l", 0.99), ("q", "equivalent_to", "x", 0.99), ("q", "equivalent_to", "l", 1.5)]
    edges = spark.createDataFrame([(i, f"r{i}", s, k, t, c, None) for i, (s, k, t, c) in enumerate(pairs)], edge)
    return r.merge_links(entities(spark), matches, nodes, edges)


def test_groups_follow_names_equivalence_and_decisions(spark):
    assert {tuple(x) for x in links(spark).collect()} == {("e1", "e2"), ("e1", "e3"), ("e3", "e4"), ("e5", "e6")}
    assert {x.vertex: x.root for x in r.union_groups(links(spark)).collect()} == {"e1": "e1", "e2": "e1", "e3": "e1", "e4": "e1", "e5": "e5", "e6": "e5"}


def test_merged_node_takes_commonest_type_and_longest_description(spark):
    late = entities(spark).replace({"T": "V"}, subset=["type"])  # the commonest type is no longer the least
    got = {x.root: tuple(x)[1:] for x in r.merged_nodes(late, r.union_groups(links(spark))).collect()}
    assert got == {"e1": ("Heap", "V", "the longest", 4, 0.9), "e5": ("Stack", "V", None, 2, 0.7), "e7": ("Queue", "V", None, 1, 0.6)}


def test_merging_keeps_chunks_sources_aliases_and_ids(spark):
    rows = [("e1", "Heap", "Heap。", ["c1", " c2", ""], [("c1", "f", 1), (None, "f", None)]), ("e2", "heap.", "heap.", ["c2", None], [("c1", "f", 1), None]), ("e3", "Pile", None, None, None)]
    df = spark.createDataFrame(rows, f"raw_id string, name string, original_name string, source_chunk_ids array<string>, sources array<{SRC}>")
    df = df.withColumns({"type": F.lit("T"), "description": F.lit("d"), "confidence": F.when(F.col("raw_id") == "e1", 0.9).otherwise(0.5), "ingested_at": F.lit(None).cast("timestamp")})
    groups = spark.createDataFrame([("e1", "e1"), ("e2", "e1")], "vertex string, root string")
    found = r.rooted(df, groups)
    of = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert of(found.select("root", "raw_id")) == [("e1", "e1"), ("e1", "e2"), ("e3", "e3")]
    assert of(g.union_rows(found, {"root": F.col("root")}, "source_chunk_ids", "chunk_id")) == [("e1", "c1"), ("e1", "c2")]
    assert of(g.source_rows(found, {"root": F.col("root")})) == [("e1", "c1", "f", 1), ("e1", None, "f", None)]
    assert of(r.merged_aliases(df, groups)) == [("e1", "heap.")]
