"""Catalog preprocessing and remaining view queries, with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella import sinks
from tessella.operators import graph as g
from tessella.operators import programming as pg
from tessella.operators import views as v
from tessella.operators.curriculum import text_matches
from tessella.plans.curriculum_queries import _CHUNK, _KEY, IX
from tessella.plans.graph_queries import KG, _STRIP, _case, _catalog_tree
from tessella.plans.question_queries import _LINKED, QQ, _links, _questions
from tessella.plans.text_queries import _any, _chunks
from tessella.runtime import table
from tessella.vocabulary import EDGE_LABELS, EXPANDABLE_TYPES, LABEL_OVERRIDES, SHOWN_NODE_TYPES

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def _graph(spark, folder):
    return g.graph_nodes(table(spark, folder, "standard_nodes")), g.graph_edges(table(spark, folder, "standard_edges"))


_SHAPES = "(?i)\\b(class|struct|template|namespace|public|private|protected)\\b|\\b(if|else|for|while|switch|return|break|continue)\\b|\\b(try|catch|throw|except|raise|import|def)\\b|[#{};]|\\b(int|double|char|bool|void|string)\\b"
_L = "lower(coalesce(content, ''))"
_HITS = f"""{IX}, c AS (SELECT *, {_KEY.format("content")} AS t FROM {_CHUNK}), h AS (SELECT chunk_id, id, max(length(key)) AS length FROM c JOIN ix ON length(key) >= 2 AND contains(t, key) GROUP BY ALL),
hn AS (SELECT chunk_id, least(count(*), 12) AS n FROM h GROUP BY chunk_id), sc0 AS (SELECT c.chunk_id, c.source_type, c.content, least(coalesce(n, 0), 4) * 2 + 2 * regexp_matches(coalesce(content, ''), '{_SHAPES}')::INT + {_any(_L, *pg.LANGUAGE_MARKERS)}::INT AS s FROM c LEFT JOIN hn USING (chunk_id)),
sc AS (SELECT chunk_id, source_type, s - CASE WHEN s < 4 AND {_any(_L, *pg.ABOUT_COURSE)} THEN 3 ELSE 0 END AS score FROM sc0)"""


def _scored(spark, folder):
    chunks = _chunks(spark, folder)
    counted = text_matches(chunks, "chunk_id", "content", table(spark, folder, "curriculum_catalog")).groupBy("chunk_id").agg(F.count("*").cast("int").alias("n"))
    return chunks.join(counted, "chunk_id", "left").select("chunk_id", "source_type", pg.relevance(F.col("content"), F.col("n")).alias("score"))


@query("f7_relevance", f"WITH {_HITS} SELECT chunk_id, score::BIGINT AS score FROM sc")
def f7_relevance(spark, folder):
    """How much each chunk speaks of the catalog."""
    return _scored(spark, folder).select("chunk_id", F.col("score").cast("bigint").alias("score"))


@query("f7_kept", f"WITH {_HITS} SELECT chunk_id FROM sc WHERE score >= CASE WHEN source_type IN ('exercise', 'docx') THEN 1 ELSE 2 END")
def f7_kept(spark, folder):
    return _scored(spark, folder).where(pg.keep_chunk(F.col("source_type"), F.col("score"))).select("chunk_id")


_DOMAINS = f"""WITH RECURSIVE {IX}, c AS (SELECT *, {_KEY.format("content")} AS t FROM {_CHUNK}), h AS (SELECT chunk_id, id, max(length(key)) AS length FROM c JOIN ix ON length(key) >= 2 AND contains(t, key) GROUP BY ALL),
hr AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY length DESC, id) AS place FROM h),
rt AS (SELECT id FROM curriculum_catalog WHERE coalesce(trim(parent_id), '') = '' OR trim(parent_id) NOT IN (SELECT id FROM curriculum_catalog)),
up AS (SELECT id, id AS top FROM curriculum_catalog WHERE trim(parent_id) IN (SELECT id FROM rt) UNION ALL SELECT k.id, up.top FROM curriculum_catalog k JOIN up ON trim(k.parent_id) = up.id),
dm AS (SELECT chunk_id, d.name AS domain, min(place) AS place FROM hr JOIN up ON up.id = hr.id JOIN curriculum_catalog d ON d.id = up.top WHERE place <= 30 AND d.name <> '' GROUP BY ALL),
dl AS (SELECT chunk_id, array_to_string(list(domain ORDER BY place, domain), '|') AS domains, count(*) AS n, first(domain ORDER BY place, domain) AS chapter FROM dm GROUP BY chunk_id)"""


@query("g9_domains", _DOMAINS + " SELECT chunk_id, domains FROM dl")
def g9_domains(spark, folder):
    """The top-level entries that each chunk's matches lie below."""
    found = pg.domain_candidates(_chunks(spark, folder), "chunk_id", "content", table(spark, folder, "curriculum_catalog"), _catalog_tree(spark, folder))
    return found.select("chunk_id", F.array_join("domains", "|").alias("domains"))


@query("t15_labels", _DOMAINS + " SELECT c.chunk_id, coalesce(dl.chapter, '未归类编程内容') AS chapter, least(0.95, (55 + 10 * least(coalesce(n, 0), 3) + CASE WHEN length(content) >= 25 THEN 10 ELSE 0 END) / 100) AS hint FROM c LEFT JOIN dl USING (chunk_id)")
def t15_labels(spark, folder):
    """Chapter and confidence of each chunk by the catalog."""
    chunks = _chunks(spark, folder)
    found = pg.domain_candidates(chunks, "chunk_id", "content", table(spark, folder, "curriculum_catalog"), _catalog_tree(spark, folder))
    rows = chunks.select("chunk_id", "content").join(found, "chunk_id", "left").withColumn("domains", F.coalesce("domains", F.array().cast("array<string>")))
    return rows.select("chunk_id", F.coalesce(F.get("domains", F.lit(0)), F.lit(pg.UNPLACED)).alias("chapter"), pg.confidence_hint(F.size("domains"), F.col("content")).alias("hint"))


@query("m3_programming")
def m3_programming(spark, folder):
    """The whole way from raw texts to chunks labelled by the catalog; a composition of tested parts."""
    rows = pg.preprocess_programming(table(spark, folder, "raw_documents"), table(spark, folder, "curriculum_catalog"), _catalog_tree(spark, folder))
    return rows.withColumn("keywords", F.array_join("keywords", " ")).withColumn("domains", F.array_join("domains", " "))


# ---------------------------------------------------------------- views

_OVER = "CASE n.id " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in LABEL_OVERRIDES.items()) + " ELSE {0} END"
_OWN = f"CASE WHEN {_STRIP.format('n.name')} <> '' THEN {_STRIP.format('n.name')} ELSE n.id END"
_D = _STRIP.format("n.description")
_MACHINE = f"n.type = 'CodeExample' AND (lower({_OWN}) LIKE 'codeexample%' OR length({_OWN}) > 28)"
_LABELLED = _OVER.format(f"CASE WHEN {_MACHINE} THEN CASE WHEN {_D} <> '' AND {_D} NOT IN ('教学材料中的代码示例', '代码示例') THEN '示例 · ' || substr({_D}, 1, 18) || CASE WHEN length({_D}) > 18 THEN '…' ELSE '' END WHEN {_STRIP.format('f.s.source_file')} <> '' THEN '示例 · ' || substr(regexp_replace({_STRIP.format('f.s.source_file')}, '(.)\\.[^.]*$', '\\1'), 1, 14) || CASE WHEN f.s.page IS NOT NULL THEN ' · P' || f.s.page ELSE '' END ELSE '代码示例 · ' || right({_OWN}, 10) END ELSE {_OWN} END")


@query(
    "t18_full_nodes",
    KG
    + f""", f AS (SELECT nid AS id, first(sources[1] ORDER BY row_id) FILTER (WHERE len(sources) > 0) AS s, first(len(source_chunk_ids) ORDER BY row_id) FILTER (WHERE len(source_chunk_ids) > 0) AS nc, first(len(sources) ORDER BY row_id) FILTER (WHERE len(sources) > 0) AS ns, first(aliases ORDER BY row_id) FILTER (WHERE len(aliases) > 0) AS aliases FROM nr GROUP BY nid)
SELECT n.id, {_LABELLED} AS label, {_case("n.type", SHOWN_NODE_TYPES, "concept")} AS shown_type, n.type AS source_type, '知识点' AS difficulty, 54 + least(coalesce(degree, 0), 8) * 5 AS size, n.confidence AS mastery, n.confidence, coalesce(degree, 0) AS relation_count, coalesce(nc, ns, 0)::BIGINT AS source_count,
  array_to_string(list_filter(al, lambda a, i: list_position(al, a) = i), '|') AS aliases, {_D} AS summary, 0::BIGINT AS exercises, CASE WHEN n.type IN ({", ".join(repr(x) for x in EXPANDABLE_TYPES)}) THEN n.id END AS children, false AS system_node
FROM n LEFT JOIN f USING (id) LEFT JOIN deg USING (id), LATERAL (SELECT list_filter(list_transform(coalesce(f.aliases, []), lambda a: {_STRIP.format("a")}), lambda a: a <> '') AS al) q""",
)
def t18_full_nodes(spark, folder):
    """The whole projection of nodes; its two empty lists are left out here."""
    rows = g.full_shown_nodes(table(spark, folder, "standard_nodes"), _graph(spark, folder)[1])
    return rows.drop("prerequisites", "outcomes").withColumn("aliases", F.array_join("aliases", "|")).withColumn("exercises", F.col("exercises").cast("bigint")).withColumn("source_count", F.col("source_count").cast("bigint"))


_PARTS = ", r1 AS (SELECT id, coalesce(name, id) AS label FROM n WHERE type = 'KnowledgeDomain'), pt AS (SELECT DISTINCT source, target FROM e WHERE type = 'part_of'), s2 AS (SELECT pt.source AS id, min(pt.target) AS root FROM pt JOIN r1 ON r1.id = pt.target JOIN n ON n.id = pt.source WHERE n.type = 'KnowledgeUnit' GROUP BY pt.source), s3 AS (SELECT pt.source AS id, min(s2.root) AS root FROM pt JOIN s2 ON s2.id = pt.target WHERE pt.source NOT IN (SELECT id FROM r1) AND pt.source NOT IN (SELECT id FROM s2) AND pt.source IN (SELECT id FROM n) GROUP BY pt.source)"
_RING = "SELECT k.id, {2} AS layer, angle + CASE WHEN sz = 1 THEN 0.0 ELSE (CASE WHEN n > 8 THEN pos // 2 ELSE pos END / (sz - 1)::DOUBLE - 0.5) * (2 * pi() / nr * 0.82) END AS a, CASE WHEN n <= 8 THEN {1}[1] WHEN pos % 2 = 0 THEN {1}[2] ELSE {1}[3] END::DOUBLE AS r FROM (SELECT *, CASE WHEN n <= 8 THEN n WHEN pos % 2 = 0 THEN (n + 1) // 2 ELSE n // 2 END AS sz FROM (SELECT x.id, x.root, row_number() OVER (PARTITION BY root ORDER BY coalesce(nn.name, nn.id), x.id) - 1 AS pos, count(*) OVER (PARTITION BY root) AS n FROM {0} x JOIN n nn ON nn.id = x.id)) k JOIN ra ON ra.id = k.root"


@query(
    "c14_positions",
    KG + _PARTS + ", ra AS (SELECT id, -pi() / 2 + (row_number() OVER (ORDER BY id) - 1) * (2 * pi() / count(*) OVER ()) AS angle, count(*) OVER () AS nr FROM r1), ps AS (SELECT id, 1 AS layer, angle AS a, 250.0::DOUBLE AS r FROM ra UNION ALL " + _RING.format("s2", "[500, 440, 555]", 2) + " UNION ALL " + _RING.format("s3", "[785, 740, 840]", 3) + ") SELECT id, layer, round(round(cos(a) * r, 2), 1) AS x, round(round(sin(a) * r, 2), 1) AS y FROM ps",
)
def c14_positions(spark, folder):
    """Where domains, their units and what is part of those stand in the overview; to one decimal, as cosines differ in the last."""
    nodes, edges = _graph(spark, folder)
    label = F.coalesce("name", "id").alias("label")
    roots = nodes.where("type = 'KnowledgeDomain'").select("id", label)
    part = edges.where("type = 'part_of'").select(F.col("source").alias("id"), "target").distinct()
    units = nodes.where("type = 'KnowledgeUnit'").select("id", label)
    second = part.join(roots.select(F.col("id").alias("target")), "target").join(units, "id").groupBy("id", "label").agg(F.min("target").alias("root"))
    third = part.join(second.select(F.col("id").alias("target"), "root"), "target").groupBy("id").agg(F.min("root").alias("root"))
    third = third.join(roots.select("id"), "id", "left_anti").join(second.select("id"), "id", "left_anti").join(nodes.select("id", label), "id")
    found = v.overview_positions(roots, second, third)
    return found.select("id", "layer", F.round("x", 1).alias("x"), F.round("y", 1).alias("y"))


@query("g18_trails", KG + ", pa AS (SELECT source AS id, arg_max(target, ord) AS up FROM e WHERE type = 'part_of' GROUP BY source), pk AS (SELECT n.id, CASE WHEN pa.up <> 'curriculum_root' AND pa.up IN (SELECT id FROM n) THEN pa.up END AS up FROM n LEFT JOIN pa USING (id)), w AS (SELECT id, id AS at, [id] AS trail FROM pk WHERE up IS NULL UNION ALL SELECT pk.id, pk.id, list_append(w.trail, pk.id) FROM w JOIN pk ON pk.up = w.id) SELECT id, array_to_string(trail, '/') AS trail FROM w")
def g18_trails(spark, folder):
    """The way from the top to every node."""
    nodes, edges = _graph(spark, folder)
    return v.trails(nodes, edges).select("id", F.array_join("trail", "/").alias("trail"))


@query("f22_label_hits", KG + "SELECT id, label FROM (SELECT label, arg_min(id, (ord, id)) AS id, min(ord) AS ord FROM (SELECT id, coalesce(name, id) AS label, ord FROM n WHERE contains(lower(id || ' ' || coalesce(name, id)), '索引树')) GROUP BY label) ORDER BY ord, id LIMIT 8")
def f22_label_hits(spark, folder):
    """A search that shows each label once."""
    return v.distinct_label_hits(_graph(spark, folder)[0], "索引树")


_SHOWN = "CASE type " + " ".join(f"WHEN '{k}' THEN '{s}'" for k, s in EDGE_LABELS.items()) + " ELSE type END"


@query("k8_localized", KG + f"SELECT id, 'MATCH (source:KnowledgeNode {{id: \"' || source || '\"}})' || chr(10) || 'MATCH (target:KnowledgeNode {{id: \"' || target || '\"}})' || chr(10) || 'MERGE (source)-[r:`' || {_SHOWN} || '` {{id: \"' || id || '\"}}]->(target)' || chr(10) || 'SET r.relation_code = \"' || type || '\", r.relation_name = \"' || {_SHOWN} || '\";' AS statement FROM e")
def k8_localized(spark, folder):
    """Edge statements with shown names of relations."""
    return sinks.localized_edge_statements(_graph(spark, folder)[1], EDGE_LABELS)


@query("k7_statements", f"{KG}, {QQ}, {_LINKED} SELECT step, count(*) AS n FROM (SELECT 0 AS step FROM range(4) UNION ALL SELECT 1 FROM qq UNION ALL SELECT 2 FROM qq UNION ALL SELECT 2 FROM qq UNION ALL SELECT 2 FROM (SELECT question_id, unnest(list_distinct(abilities)) FROM qq) UNION ALL SELECT 3 FROM link) GROUP BY step")
def k7_statements(spark, folder):
    """How many statements each step of the question import has."""
    return sinks.question_statements(_questions(spark, folder), _links(spark, folder)).groupBy("step").agg(F.count("*").alias("n"))


@query("k4_script", KG + "SELECT step, count(*) AS n FROM (SELECT 0 AS step UNION ALL SELECT 1 UNION ALL SELECT 2 FROM n UNION ALL SELECT 3 FROM e) GROUP BY step")
def k4_script(spark, folder):
    """How many statements each step of the graph import has, with a wipe."""
    nodes, edges = _graph(spark, folder)
    return sinks.graph_script(nodes, edges, g.node_aliases(table(spark, folder, "standard_nodes")), wipe=True).groupBy("step").agg(F.count("*").alias("n"))
