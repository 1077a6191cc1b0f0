"""Property-graph operators: views, degrees, neighbourhoods, ranking, checks.

A graph is a pair of DataFrames: nodes (id, name, type, description,
confidence) and edges (id, source, target, type, confidence,
evidence).  Every operator is a plan over them; none collects the graph.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessella.functions.coerce import distinct_texts, first_text, strength, text
from tessella.vocabulary import EDGE_LABELS, EXAMPLE_PRIORITY, EXPANDABLE_TYPES, LABEL_OVERRIDES, RELATION_SCHEMA, SHOWN_EDGE_TYPES, SHOWN_NODE_TYPES, SUPPORT_RELATIONS, SUPPORT_TYPES


def node_id(raw: Column) -> Column:
    return F.lower(F.trim(raw))


def sound(confidence: Column) -> Column:
    """The confidence where it lies in (0, 1], else null."""
    return F.when((confidence > 0) & (confidence <= 1), confidence)


def graph_nodes(rows: DataFrame) -> DataFrame:
    """One node per id: first name and type, longest description, greatest sound confidence.

    The first row is the one with the smallest row_id.  Rows with a blank id are left out.
    """
    keyed = rows.withColumn("nid", node_id(F.col("id"))).where("nid <> ''")
    longest = F.struct(F.char_length("description"), -F.col("row_id"))
    return keyed.groupBy(F.col("nid").alias("id")).agg(
        F.min_by("name", F.when(F.col("name").isNotNull(), F.col("row_id"))).alias("name"),
        F.min_by("type", F.when(F.col("type").isNotNull(), F.col("row_id"))).alias("type"),
        F.max_by("description", F.when(F.col("description").isNotNull(), longest)).alias("description"),
        F.coalesce(F.max(sound(F.col("confidence"))), F.lit(0.0)).alias("confidence"),
        F.min("row_id").alias("ord"),
    )


def node_aliases(rows: DataFrame) -> DataFrame:
    """(id, alias): every distinct alias of every node, stripped; rows, so that no node gathers them all."""
    return rows.select(node_id(F.col("id")).alias("id"), F.explode(distinct_texts(F.col("aliases"))).alias("alias")).where("id <> ''").distinct()


def union_rows(rows: DataFrame, keys: dict[str, Column], column: str, name: str) -> DataFrame:
    """(keys, name): every distinct non-blank member of a list column of each group, stripped; rows, so that no group gathers them all."""
    return rows.select(*(k.alias(n) for n, k in keys.items()), F.explode(distinct_texts(F.col(column))).alias(name)).distinct()


def source_rows(rows: DataFrame, keys: dict[str, Column], column: str = "sources") -> DataFrame:
    """(keys, chunk_id, source_file, page): every distinct source of each group, key-less ones included."""
    each = rows.select(*(k.alias(n) for n, k in keys.items()), F.explode(column).alias("_s")).where("_s IS NOT NULL")
    return each.select(*keys, "_s.chunk_id", "_s.source_file", "_s.page").distinct()


def graph_edges(rows: DataFrame) -> DataFrame:
    """One edge per (source, type, target): smallest id, greatest sound confidence, longest evidence."""
    keyed = rows.select("row_id", "id", node_id(F.col("source")).alias("source"), "type", node_id(F.col("target")).alias("target"), "confidence", "evidence").where("source <> '' AND target <> ''")
    longest = F.struct(F.char_length("evidence"), -F.col("row_id"))
    return keyed.groupBy("source", "type", "target").agg(
        F.min("id").alias("id"),
        F.coalesce(F.max(sound(F.col("confidence"))), F.lit(0.0)).alias("confidence"),
        F.max_by("evidence", F.when(F.col("evidence").isNotNull(), longest)).alias("evidence"),
        F.min("row_id").alias("ord"),
    )


def degrees(edges: DataFrame) -> DataFrame:
    """(id, degree): ends of edges at each node; a loop counts twice."""
    return edges.select(F.explode(F.array("source", "target")).alias("id")).where("id <> ''").groupBy("id").agg(F.count("*").alias("degree"))


def adjacency(edges: DataFrame) -> DataFrame:
    """(id, neighbour): both directions, each pair once; a loop makes a node its own neighbour."""
    there = edges.select(F.col("source").alias("id"), F.col("target").alias("neighbour"))
    return there.unionByName(edges.select(F.col("target").alias("id"), F.col("source").alias("neighbour"))).where("id <> '' AND neighbour <> ''").distinct()


def neighbour_counts(edges: DataFrame) -> DataFrame:
    return adjacency(edges).groupBy("id").agg(F.count("*").alias("neighbours"))


def with_endpoints(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with the types of both ends; null for unknown ends."""
    side = lambda c: nodes.select(F.col("id").alias(c), F.col("type").alias(f"{c}_type"))
    return edges.join(side("source"), "source", "left").join(side("target"), "target", "left")


def induced(edges: DataFrame, kept: DataFrame) -> DataFrame:
    """Edges with both ends among ``kept.id``."""
    ids = kept.select("id").distinct()
    return edges.join(ids.withColumnRenamed("id", "source"), "source", "left_semi").join(ids.withColumnRenamed("id", "target"), "target", "left_semi")


def schema_triples(spark, schema=None) -> DataFrame:
    """(type, source_type, target_type): the allowed triples; a fixed, small table."""
    rows = [(r, h, t) for r, (heads, tails) in (schema or RELATION_SCHEMA).items() for h in heads for t in tails]
    return spark.createDataFrame(rows, "type string, source_type string, target_type string")


def schema_check(edges: DataFrame, nodes: DataFrame, schema=None) -> DataFrame:
    """Edges with ``valid``: whether the schema allows their relation between these types."""
    allowed = schema_triples(edges.sparkSession, schema).withColumn("allowed", F.lit(True))
    return with_endpoints(edges, nodes).join(F.broadcast(allowed), ["type", "source_type", "target_type"], "left").withColumn("valid", F.coalesce("allowed", F.lit(False))).drop("allowed")


def within_hops(edges: DataFrame, start: DataFrame, depth: int) -> DataFrame:
    """(id, hops): nodes at most ``depth`` (1 to 3) undirected steps from the start ids, with the least number."""
    depth = max(1, min(depth, 3))
    pairs = adjacency(edges)
    seen = start.select("id").distinct().withColumn("hops", F.lit(0))
    for hop in range(1, depth + 1):
        nxt = seen.where(F.col("hops") == hop - 1).select("id").join(pairs, "id").select(F.col("neighbour").alias("id")).distinct().withColumn("hops", F.lit(hop))
        seen = seen.unionByName(nxt).groupBy("id").agg(F.min("hops").alias("hops"))
    return seen


def radial_layers(ids: DataFrame, edges: DataFrame, focus: Column) -> DataFrame:
    """(id, layer): 1 for the focus, 2 for its direct neighbours, 3 for all others."""
    near = induced(edges, ids)
    beside = adjacency(near).where(F.col("neighbour") == focus).select("id", F.lit(2).alias("beside"))
    return ids.select("id").distinct().join(beside, "id", "left").select("id", F.when(F.col("id") == focus, 1).otherwise(F.coalesce("beside", F.lit(3))).alias("layer"))


def hierarchy_overview(nodes: DataFrame, edges: DataFrame, root_type: str, child_type: str) -> DataFrame:
    """(id, layer) of roots, their children of ``child_type`` and whatever is part of those; the later layer wins."""
    part = edges.where("type = 'part_of'").select("source", "target")
    roots = nodes.where(F.col("type") == root_type).select("id")
    major = part.join(roots.withColumnRenamed("id", "target"), "target", "left_semi").join(nodes.where(F.col("type") == child_type).select(F.col("id").alias("source")), "source", "left_semi").select(F.col("source").alias("id")).distinct()
    minor = part.join(major.withColumnRenamed("id", "target"), "target", "left_semi").select(F.col("source").alias("id"))
    rows = roots.withColumn("layer", F.lit(1)).unionByName(major.withColumn("layer", F.lit(2))).unionByName(minor.withColumn("layer", F.lit(3)))
    return rows.groupBy("id").agg(F.max("layer").alias("layer"))


def example_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(owner, example, type, confidence): edges that give a node a code example, in either direction."""
    typed = with_endpoints(edges, nodes)
    incoming = typed.where("type IN ('demonstrates', 'uses_syntax', 'contains_structure') AND source_type = 'CodeExample'").select(F.col("target").alias("owner"), F.col("source").alias("example"), "type", "confidence")
    return incoming.unionByName(typed.where("type = 'has_code_example' AND target_type = 'CodeExample'").select(F.col("source").alias("owner"), F.col("target").alias("example"), "type", "confidence"))


def priority(kind: Column, order: dict[str, int], other: int = 9) -> Column:
    out = F.lit(other)
    for name, rank in order.items():
        out = F.when(kind == name, rank).otherwise(out)
    return out


def top_examples(edges: DataFrame, nodes: DataFrame, most: int = 12) -> DataFrame:
    """(owner, example, place): the first ``most`` distinct examples of every node, by relation, confidence and id."""
    best = example_edges(edges, nodes).groupBy("owner", "example").agg(F.min(F.struct(priority(F.col("type"), EXAMPLE_PRIORITY).alias("p"), (-F.col("confidence")).alias("c"))).alias("best"))
    order = Window.partitionBy("owner").orderBy("best.p", "best.c", "example")
    return best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).select("owner", "example", "place")


def support_edges(edges: DataFrame, nodes: DataFrame, most: int = 20) -> DataFrame:
    """(owner, id, support, place): of every node's chosen examples the ``most`` surest edges to what they use."""
    typed = with_endpoints(edges, nodes).where(F.col("type").isin(*SUPPORT_RELATIONS))
    at_source = F.coalesce(F.col("source_type") == "CodeExample", F.lit(False))
    sided = typed.select("id", "source", "target", "confidence", F.when(at_source, F.col("source")).when(F.col("target_type") == "CodeExample", F.col("target")).alias("example"), F.when(at_source, F.col("target")).otherwise(F.col("source")).alias("support"), F.when(at_source, F.col("target_type")).otherwise(F.col("source_type")).alias("support_type"))
    sided = sided.where(F.col("example").isNotNull() & F.col("support_type").isin(*SUPPORT_TYPES))
    rows = top_examples(edges, nodes).select("owner", "example").join(sided, "example")
    order = Window.partitionBy("owner").orderBy(F.desc("confidence"), "source", "target", "id")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).select("owner", "id", "support", "place")


def example_home(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(example, home): the graph view that a search hit on an example opens."""
    rank = {"KnowledgePoint": 0, "KnowledgeUnit": 1, "KnowledgeDomain": 2}
    typed = nodes.select(F.col("id").alias("owner"), F.col("type").alias("owner_type")).where(F.col("owner_type").isin(*rank))
    best = example_edges(edges, nodes).join(typed, "owner").groupBy("example").agg(F.min(F.struct(priority(F.col("owner_type"), rank), -F.col("confidence"), F.col("owner").alias("owner"))).alias("best"))
    return best.select("example", F.col("best.owner").alias("home"))


def focus_edges(edges: DataFrame, nodes: DataFrame, focus: str, depth: int = 1) -> DataFrame:
    """Edges of the view of one node, chosen by the node's type.

    Domains show domains and units, units show domains and points (and
    examples if they have no point), points show their units, core mappings,
    examples and what these use; any other node shows its neighbourhood.
    """
    spark = edges.sparkSession
    row = nodes.where(F.col("id") == focus).select("type").take(1)
    columns = ["id", "source", "target", "type", "confidence", "ord"]
    if not row:
        return edges.select(*columns).limit(0)
    kind = row[0].type
    here = F.lit(focus)
    typed = with_endpoints(edges, nodes)
    touching = typed.where((F.col("source") == here) | (F.col("target") == here))
    other = F.when(F.col("source") == here, F.col("target_type")).otherwise(F.col("source_type"))
    parts = touching.where("type = 'part_of'")
    own = spark.createDataFrame([(focus,)], "owner string")
    chosen = top_examples(edges, nodes).join(own, "owner", "left_semi").select(F.col("example"))
    to_example = F.when(F.col("source_type") == "CodeExample", F.col("source")).when(F.col("target_type") == "CodeExample", F.col("target"))
    shown = touching.withColumn("example", to_example).where(F.col("type").isin(*EXAMPLE_PRIORITY)).join(chosen, "example", "left_semi")
    if kind == "KnowledgeDomain":
        return parts.where(other.isin("KnowledgeDomain", "KnowledgeUnit")).select(*columns)
    if kind == "KnowledgeUnit":
        picked = parts.where(other.isin("KnowledgeDomain", "KnowledgePoint"))
        points = parts.where((F.col("target") == here) & (F.col("source_type") == "KnowledgePoint"))
        if points.take(1):
            return picked.select(*columns)
        return picked.select(*columns).unionByName(shown.select(*columns)).dropDuplicates(["id"])
    if kind == "KnowledgePoint":
        picked = parts.where(other == "KnowledgeUnit").select(*columns)
        mapped = touching.where("type = 'maps_to_core'").select(*columns)
        used = support_edges(edges, nodes).join(own, "owner", "left_semi").select("id")
        support = edges.join(used, "id", "left_semi").select(*columns)
        return picked.unionByName(mapped).unionByName(shown.select(*columns)).unionByName(support).dropDuplicates(["id"])
    near = within_hops(edges, spark.createDataFrame([(focus,)], "id string"), depth)
    return induced(edges, near).select(*columns)


def visible_nodes(ids: DataFrame, edges: DataFrame, required: str, most: int) -> DataFrame:
    """(id, degree, place): the required node first, then by degree; ties by id."""
    ranked = ids.join(degrees(edges), "id", "left").select("id", F.coalesce("degree", F.lit(0)).alias("degree"))
    top = ranked.orderBy((F.col("id") == required).desc(), F.desc("degree"), "id").limit(most)
    return top.withColumn("place", F.row_number().over(Window.orderBy((F.col("id") == required).desc(), F.desc("degree"), "id")))


def mapped(value: Column, groups: dict[str, tuple[str, ...]], other: str) -> Column:
    out = F.lit(other)
    for shown, names in groups.items():
        out = F.when(F.lower(value).isin(*names), shown).otherwise(out)
    return out


def node_label(nodes_type: Column, name: Column, id: Column, description: Column, source_file: Column | None = None, page: Column | None = None, overrides: dict[str, str] | None = None) -> Column:
    """The label shown: an override by id, else the name, else the id.

    Examples with machine-made or long names take their description, else the
    stem of their first source and its page, else the name's end.
    """
    label = first_text(name, id)
    example = (nodes_type == "CodeExample") & (F.lower(label).startswith("codeexample") | (F.char_length(label) > 28))
    about = text(description)
    useful = (about != "") & ~about.isin("教学材料中的代码示例", "代码示例")
    told = F.concat(F.lit("示例 · "), F.substring(about, 1, 18), F.when(F.char_length(about) > 18, "…").otherwise(""))
    tail = F.concat(F.lit("代码示例 · "), F.right(label, F.lit(10)))
    out = F.when(example & useful, told)
    if source_file is not None:
        file = text(source_file)
        stem = F.substring(F.regexp_replace(file, r"(?<=.)\.[^.]*$", ""), 1, 14)
        place = F.when(page.isNotNull(), F.concat(F.lit(" · P"), page.cast("string"))).otherwise("") if page is not None else F.lit("")
        out = out.when(example & (file != ""), F.concat(F.lit("示例 · "), stem, place))
    out = out.when(example, tail).otherwise(label)
    for key, shown in (overrides or {}).items():
        out = F.when(id == key, shown).otherwise(out)
    return out


def shown_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The projection of nodes for a view."""
    rows = nodes.join(degrees(edges), "id", "left")
    degree = F.coalesce("degree", F.lit(0))
    return rows.select(
        "id",
        node_label(F.col("type"), F.col("name"), F.col("id"), F.col("description")).alias("label"),
        mapped(F.col("type"), SHOWN_NODE_TYPES, "concept").alias("shown_type"),
        F.col("type").alias("source_type"),
        (54 + F.least(degree, F.lit(8)) * 5).alias("size"),
        "confidence",
        degree.alias("relation_count"),
        text(F.col("description")).alias("summary"),
        F.when(F.col("type").isin(*EXPANDABLE_TYPES), F.col("id")).alias("children"),
    )


def full_shown_nodes(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """The whole projection of nodes for a view, from the rows before merging.

    Sources are those of the first row of a node that has any; fields that the
    tables don't hold have their defaults (difficulty 知识点, no lists, 0).
    """
    nodes = graph_nodes(rows)
    keyed = rows.select(node_id(F.col("id")).alias("id"), "row_id", "aliases", "source_chunk_ids", "sources").where("id <> ''")
    has = lambda c: F.when(F.size(c) > 0, F.col("row_id"))
    first = keyed.groupBy("id").agg(
        F.min_by(F.get("sources", F.lit(0)), has("sources")).alias("source"),
        F.min_by(F.size("source_chunk_ids"), has("source_chunk_ids")).alias("n_chunks"),
        F.min_by(F.size("sources"), has("sources")).alias("n_sources"),
        F.min_by("aliases", has("aliases")).alias("aliases"),
    )
    wide = nodes.join(first, "id", "left").join(degrees(edges), "id", "left")
    degree = F.coalesce("degree", F.lit(0))
    none = F.array().cast("array<string>")
    return wide.select(
        "id",
        node_label(F.col("type"), F.col("name"), F.col("id"), F.col("description"), F.col("source.source_file"), F.col("source.page"), LABEL_OVERRIDES).alias("label"),
        mapped(F.col("type"), SHOWN_NODE_TYPES, "concept").alias("shown_type"),
        F.col("type").alias("source_type"),
        F.lit("知识点").alias("difficulty"),
        (54 + F.least(degree, F.lit(8)) * 5).alias("size"),
        F.col("confidence").alias("mastery"),
        "confidence",
        degree.alias("relation_count"),
        F.coalesce("n_chunks", "n_sources", F.lit(0)).alias("source_count"),
        distinct_texts(F.col("aliases")).alias("aliases"),
        text(F.col("description")).alias("summary"),
        none.alias("prerequisites"),
        none.alias("outcomes"),
        F.lit(0).alias("exercises"),
        F.when(F.col("type").isin(*EXPANDABLE_TYPES), F.col("id")).alias("children"),
        F.lit(False).alias("system_node"),
    )


def shown_edges(edges: DataFrame) -> DataFrame:
    """The projection of edges for a view; part_of turns to point from whole to part."""
    part = F.col("type") == "part_of"
    label = F.lit("关联关系")
    for name, shown in EDGE_LABELS.items():
        label = F.when(F.lower("type") == name, shown).otherwise(label)
    return edges.select(
        first_text(F.col("id"), F.concat("source", F.lit("->"), "target", F.lit(":"), "type")).alias("id"),
        F.when(part, F.col("target")).otherwise(F.col("source")).alias("source"),
        F.when(part, F.col("source")).otherwise(F.col("target")).alias("target"),
        label.alias("label"),
        mapped(F.col("type"), SHOWN_EDGE_TYPES, "related").alias("shown_type"),
        strength(F.col("confidence")).cast("bigint").alias("strength"),
    )


def paths_between(edges: DataFrame, relation: str, most: int = 3) -> DataFrame:
    """(start, finish, length): directed walks of one to ``most`` edges of a relation, no edge used twice."""
    steps = edges.where(F.col("type") == relation).select("source", "target", F.col("id").alias("eid"))
    walk = steps.select(F.col("source").alias("start"), F.col("target").alias("finish"), F.array("eid").alias("used"))
    out = walk
    for _ in range(1, most):
        walk = walk.join(steps, F.col("finish") == F.col("source")).where(~F.array_contains("used", F.col("eid"))).select("start", F.col("target").alias("finish"), F.array_append("used", F.col("eid")).alias("used"))
        out = out.unionByName(walk)
    return out.select("start", "finish", F.size("used").cast("bigint").alias("length"))


def bridging_examples(edges: DataFrame, nodes: DataFrame, least: int = 2) -> DataFrame:
    """(example, others): examples that join at least ``least`` different nodes other than examples."""
    ends = with_endpoints(edges, nodes)
    out = ends.where("source_type = 'CodeExample' AND target_type <> 'CodeExample'").select(F.col("source").alias("example"), F.col("target").alias("other"))
    rows = out.unionByName(ends.where("target_type = 'CodeExample' AND source_type <> 'CodeExample'").select(F.col("target").alias("example"), F.col("source").alias("other")))
    return rows.groupBy("example").agg(F.countDistinct("other").alias("others")).where(F.col("others") >= least)


def integrity(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row of counters: nodes, edges, dangling edges, loops, isolated nodes, repeated triples."""
    ends = with_endpoints(edges, nodes.select("id", F.lit("x").alias("type")))
    valid = F.col("source_type").isNotNull() & F.col("target_type").isNotNull()
    counts = ends.agg(F.count("*").alias("edges"), F.count_if(~valid).alias("invalid_edges"), F.count_if(valid & (F.col("source") == F.col("target"))).alias("self_loops"))
    joined = ends.where(valid).select(F.explode(F.array("source", "target")).alias("id")).distinct()
    alone = nodes.select("id").join(joined, "id", "left_anti").agg(F.count("*").alias("isolated_nodes"))
    return nodes.agg(F.count("*").alias("nodes")).crossJoin(counts).crossJoin(alone)
