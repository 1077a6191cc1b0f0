"""Views and audits: trimmed edge sets, acyclicity, triples, question blocks, JSON in texts."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessella.operators.graph import priority
from tessella.operators.hierarchy import resolve_hierarchy
from tessella.runtime import Scratch
from tessella.vocabulary import VIEW_PRIORITY


def trimmed_edges(edges: DataFrame, view: str, most: int = 36, full: int = 500) -> DataFrame:
    """The edges of each view, at most ``most``: first those that reach a new node, then the next in order.

    Views within the limit keep all. The order is relation, confidence, source
    and target. A view may end with one edge more than ``most``, as the cover
    itself may fill it.  Each view is bounded by the node limit before, so one
    group is one task's work.
    """
    rank = priority(F.col("type"), VIEW_PRIORITY)

    def trim(rows: pd.DataFrame) -> pd.DataFrame:
        if len(rows) <= most:
            return rows.drop(columns="rank")
        rows = rows.sort_values(["rank", "confidence", "source", "target", "id"], ascending=[True, False, True, True, True], kind="stable")
        seen: set = set()
        chosen: list[int] = []
        for at, (s, t) in enumerate(zip(rows["source"], rows["target"])):
            if s not in seen or t not in seen:
                chosen.append(at)
                seen |= {s, t}
                if len(chosen) >= most:
                    break
        if len(chosen) < full:
            taken = set(chosen)
            for at in range(len(rows)):
                if at not in taken:
                    chosen.append(at)
                    if len(chosen) >= most:
                        break
        return rows.iloc[chosen].drop(columns="rank")

    picked = edges.select(view, "id", "source", "target", "type", "confidence", rank.alias("rank"))
    schema = picked.drop("rank").schema
    return picked.groupBy(view).applyInPandas(trim, schema)


def _peel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges left when nodes without an edge in or out are peeled off, in time linear in the edges."""
    edges = {e for b in batches for e in zip(*(c.to_pylist() for c in b.columns))}
    for flip in (False, True):
        into, out = Counter(), defaultdict(list)
        for s, t in edges:
            s, t = (t, s) if flip else (s, t)
            into[t] += 1
            out[s].append(t)
        ready = [n for n in out if not into[n]]
        gone = set()
        while ready:
            n = ready.pop()
            gone.add(n)
            for t in out.get(n, ()):
                into[t] -= 1
                if not into[t]:
                    ready.append(t)
        edges = {(s, t) for s, t in edges if (t if flip else s) not in gone}
    if edges:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*edges)], names=["source", "target"])


def cyclic_part(edges: DataFrame, finish: int = 500_000) -> DataFrame:
    """(source, target): directed edges on a cycle or on a way between cycles; empty if the graph is acyclic.

    Nodes without an edge in or without an edge out are peeled off round by
    round; rounds are written and the lineage cut.  Once no more than
    ``finish`` edges are left one task peels the rest to the end, however long
    its ways are.
    """
    scratch = Scratch(edges.sparkSession, "cyclic")
    rest = scratch.write(edges.select("source", "target").distinct(), "rest0")
    left, turn = rest.count(), 0
    while left > finish:
        kept = rest.join(rest.select(F.col("target").alias("source")).distinct(), "source", "left_semi").join(rest.select(F.col("source").alias("target")).distinct(), "target", "left_semi").select("source", "target")
        turn += 1
        rest, before = scratch.write(kept, f"rest{turn}"), left
        scratch.drop(f"rest{turn - 1}")
        left = rest.count()
        if left == before:
            return rest
    return rest.coalesce(1).mapInArrow(_peel, "source string, target string")


def triples(nodes: DataFrame, edges: DataFrame, base: str = "kg:") -> DataFrame:
    """(subject, predicate, object): the graph as triples, names and types as literals."""
    name = lambda c: F.concat(F.lit(f"<{base}"), F.regexp_replace(c, r"[<>\"{}|\\^`\s]", "_"), F.lit(">"))
    literal = lambda c: F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"\\", r"\\\\"), '"', r'\\"'), F.lit('"'))
    facts = F.array(F.struct(F.lit("name").alias("predicate"), literal(F.col("name")).alias("object")), F.struct(F.lit("type").alias("predicate"), literal(F.col("type")).alias("object")))
    own = nodes.select(name(F.col("id")).alias("subject"), F.inline(facts))
    return own.unionByName(edges.select(name(F.col("source")).alias("subject"), F.col("type").alias("predicate"), name(F.col("target")).alias("object")))


def json_object(content: Column) -> Column:
    """The JSON object in a text, from a fenced block or between the outermost braces; null if there is none."""
    found = F.regexp_extract(F.regexp_replace(F.coalesce(content, F.lit("")), r"(?s)^\s*```(?:json)?|```\s*$", ""), r"(?s)\{.*\}", 0)
    return F.when(F.try_parse_json(found).isNotNull() & (found != ""), found)


#: Radii of the overview's rings, from the inner to the outer, and when a ring is split in two.
ROOT_RADIUS, DENSE = 250, 8
SECOND = {"one": 500, "inner": 440, "outer": 555}
THIRD = {"one": 785, "inner": 740, "outer": 840}


def overview_positions(roots: DataFrame, seconds: DataFrame, thirds: DataFrame) -> DataFrame:
    """(id, layer, x, y): roots on a circle, their children and grandchildren on rings in the root's sector.

    ``roots`` is (id, label), ``seconds`` and ``thirds`` (id, label, root), each
    below one root.  A ring of more than eight is split into two, whose members
    alternate by label.  An overview is small; ranks come from windows.
    """
    turn = 2 * math.pi
    ordered = roots.withColumn("at", F.row_number().over(Window.orderBy("id")) - 1).crossJoin(roots.agg(F.count("*").alias("n_roots")))
    placed = ordered.select("id", "label", "n_roots", (F.lit(-math.pi / 2) + F.col("at") * (turn / F.col("n_roots"))).alias("angle"))
    sector = (turn / F.col("n_roots")) * 0.82

    def ring(rows: DataFrame, radii: dict[str, int], layer: int) -> DataFrame:
        own = Window.partitionBy("root")
        ranked = rows.select("id", "label", "root").distinct().withColumn("at", F.row_number().over(own.orderBy("label", "id")) - 1).withColumn("n", F.count("*").over(own))
        dense = F.col("n") > DENSE
        inner = F.col("at") % 2 == 0
        size = F.when(~dense, F.col("n")).when(inner, F.ceil(F.col("n") / 2)).otherwise(F.floor(F.col("n") / 2))
        place = F.when(dense, F.floor(F.col("at") / 2)).otherwise(F.col("at"))
        radius = F.when(~dense, radii["one"]).when(inner, radii["inner"]).otherwise(radii["outer"])
        joined = ranked.join(placed.select(F.col("id").alias("root"), "angle", "n_roots"), "root")
        offset = F.when(size == 1, F.lit(0.0)).otherwise((place / (size - 1) - 0.5) * sector)
        return joined.select("id", F.lit(layer).alias("layer"), (F.col("angle") + offset).alias("a"), radius.cast("double").alias("r"))

    rows = placed.select("id", F.lit(1).alias("layer"), F.col("angle").alias("a"), F.lit(float(ROOT_RADIUS)).alias("r")).unionByName(ring(seconds, SECOND, 2)).unionByName(ring(thirds, THIRD, 3))
    return rows.select("id", "layer", F.round(F.cos("a") * F.col("r"), 2).alias("x"), F.round(F.sin("a") * F.col("r"), 2).alias("y"))


def trails(nodes: DataFrame, edges: DataFrame, top: str = "curriculum_root") -> DataFrame:
    """(id, trail, labels): the way from the top to each node along part_of, without the top itself.

    Of several parents the last edge counts.  Nodes on or below a loop have no
    trail; a node without a parent is its own.
    """
    parents = edges.where("type = 'part_of'").groupBy(F.col("source").alias("id")).agg(F.max_by("target", "ord").alias("parent_id"))
    time = F.lit(None).cast("timestamp")
    links = nodes.select("id").join(parents, "id", "left").select("id", F.when(F.lower("parent_id") != top, F.col("parent_id")).alias("parent_id"), time.alias("updated_at"), time.alias("ingested_at"))
    found = resolve_hierarchy(links).where("path IS NOT NULL").select("id", F.col("path").alias("trail"))
    names = nodes.select(F.col("id").alias("step"), F.coalesce("name", "id").alias("label"))
    each = found.select("id", F.posexplode("trail").alias("at", "step")).join(names, "step").groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "label"))), lambda x: x["label"]).alias("labels"))
    return found.join(each, "id")


def distinct_label_hits(nodes: DataFrame, word: str, most: int = 8) -> DataFrame:
    """(id, label): nodes whose name or id holds a word, one of each label, in table order."""
    low = word.strip().lower()
    rows = nodes.select("id", F.coalesce("name", "id").alias("label"), "ord").where(F.contains(F.lower(F.concat_ws(" ", "id", "label")), F.lit(low)))
    return rows.groupBy("label").agg(F.min(F.struct("ord", "id")).alias("f")).select("f.id", "label", "f.ord").orderBy("ord", "id").limit(most).select("id", "label")


def health_message(row: Column) -> Column:
    """What a health row says in words; nothing wrong gives 正常."""
    parts = [("invalid_edges", "无效关系"), ("self_loops", "自环关系"), ("isolated_nodes", "孤立节点"), ("unresolved_links", "未解析映射"), ("questions_without_mapping", "未映射习题")]
    found = F.array_compact(F.array(*(F.when(row[c] > 0, F.concat(row[c].cast("string"), F.lit(f" 个{shown}"))) for c, shown in parts)))
    return F.when(F.size(found) == 0, "正常").otherwise(F.array_join(found, "，"))
