"""Consolidating pairwise matches into groups.

Method: seed-tree pruning.  In a round every vertex proposes the minimum of
its neighbourhood to all its neighbours.  A vertex that nobody proposes is not
minimal anywhere: it drops out and hangs below the least vertex proposed to it
in the propagation forest.  The vertices that stay are linked to the least of
their proposals, which is a smaller graph with the same components.  When no
link is left the seeds' identifiers flow down the forest.

Neighbourhoods are only ever aggregated, never gathered, so a hub with a third
of all links costs partial minima.  Each round's tables are written to the
shared folder and the previous ones removed.  What a round leaves is finished
in one task once it is no more than ``finish`` links: the same groups, without
rounds that cost more to start than to run.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.runtime import Scratch


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(child, above) from links (a, b): each vertex but the least of its group hangs below that least one."""
    top: dict = {}

    def find(x):
        while (y := top.setdefault(x, x)) != x:
            top[x] = x = top.setdefault(y, y)
        return x

    kind = None
    for batch in batches:
        kind = batch.schema.types[0]
        for a, b in zip(*(c.to_pylist() for c in batch.columns)):
            a, b = find(a), find(b)
            top[max(a, b)] = min(a, b)
    below = [(v, find(v)) for v in list(top) if find(v) != v]
    if below:
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c in zip(*below)], names=["child", "above"])


def components(links: DataFrame, left: str, right: str, finish: int = 50_000) -> DataFrame:
    """(vertex, group_id) of every vertex with a link to another one.

    ``group_id`` is the smallest vertex reachable, in byte order (which for
    UTF-8 is code point order).  Links with a null end and links of a vertex
    with itself link nothing; repeated and reversed links count once.
    """
    scratch = Scratch(links.sparkSession, "components")
    pairs = links.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    graph = scratch.write(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "graph0")
    kind = pairs.schema["a"].dataType.simpleString()
    forest: list[DataFrame] = []
    turn, left_over = 0, graph.count()
    while left_over:
        if turn and left_over <= finish:
            rest = graph.coalesce(1).mapInArrow(_finish, f"child {kind}, above {kind}")
            forest.append(scratch.write(rest, "rest"))
            break
        both = graph.unionByName(graph.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # (u, m): the least of u and its neighbours.
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # (v, m): m was proposed to v, by v itself or by a neighbour.
        proposed = both.join(least, "a").select(F.col("b").alias("v"), "m").unionByName(least.select(F.col("a").alias("v"), "m")).distinct()
        proposed = scratch.write(proposed, f"proposed{turn}")
        ranked = proposed.groupBy("v").agg(F.min("m").alias("least"), F.max(F.col("m") == F.col("v")).alias("stays"))
        ranked = scratch.write(ranked, f"ranked{turn}")
        forest.append(ranked.where("NOT stays").select(F.col("v").alias("child"), F.col("least").alias("above")))
        nxt = proposed.join(ranked.select("v", "least"), "v").where("m <> least").select(F.least("m", "least").alias("a"), F.greatest("m", "least").alias("b")).distinct()
        graph = scratch.write(nxt, f"graph{turn + 1}")
        scratch.drop(f"graph{turn}")
        scratch.drop(f"proposed{turn}")
        turn += 1
        left_over = graph.count()
    if not forest:
        return links.sparkSession.createDataFrame([], f"vertex {kind}, group_id {kind}")
    # A vertex of a late turn lies above those of earlier ones: going back, each child's parent is answered already.
    answered: list[DataFrame] = []
    for k, tree in enumerate(reversed(forest)):
        if not answered:
            found = tree.select(F.col("child").alias("vertex"), F.col("above").alias("group_id"))
        else:
            top = reduce(DataFrame.unionByName, answered).select(F.col("vertex").alias("above"), "group_id")
            found = tree.join(top, "above", "left").select(F.col("child").alias("vertex"), F.coalesce("group_id", "above").alias("group_id"))
        answered.append(scratch.write(found, f"answered{k}"))
    everyone = reduce(DataFrame.unionByName, answered)
    seeds = everyone.select(F.col("group_id").alias("vertex")).distinct().withColumn("group_id", F.col("vertex"))
    return everyone.unionByName(seeds)


def entity_links(prepared: DataFrame, matches: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): what says that two known records are one entity.

    Links are matches with verdict exactly ``same`` and the members of one
    ``original_entity_ids`` array, tied to its least known member as a star.
    Ids that are no ``raw_id`` link nothing.
    """
    known = prepared.where("raw_id IS NOT NULL").select("raw_id").distinct()
    same = matches.where("verdict = 'same' AND left_id <> right_id").select(F.least("left_id", "right_id").alias("a"), F.greatest("left_id", "right_id").alias("b")).distinct()
    same = same.join(known.withColumnRenamed("raw_id", "a"), "a", "left_semi").join(known.withColumnRenamed("raw_id", "b"), "b", "left_semi")
    lists = nodes.where(F.size("original_entity_ids") > 1).select(F.array_distinct(F.filter("original_entity_ids", lambda x: x.isNotNull())).alias("ids")).where(F.size("ids") > 1)
    members = lists.select(F.monotonically_increasing_id().alias("row"), "ids")
    scratch = Scratch(prepared.sparkSession, "entity-links")
    members = scratch.write(members, "members")
    each = members.select("row", F.explode("ids").alias("raw_id")).join(known, "raw_id", "left_semi")
    heads = each.groupBy("row").agg(F.min("raw_id").alias("a"))
    stars = each.join(heads, "row").where("raw_id <> a").select("a", F.col("raw_id").alias("b"))
    return same.select("a", "b").unionByName(stars)
