"""Graph queries over the standard nodes and edges, with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.operators import graph as g
from tessella.operators.hierarchy import descendants, resolve_hierarchy
from tessella.runtime import table
from tessella.vocabulary import EDGE_LABELS, EXPANDABLE_TYPES, RELATION_SCHEMA, SHOWN_EDGE_TYPES, SHOWN_NODE_TYPES


def _graph(spark, folder):
    return g.graph_nodes(table(spark, folder, "standard_nodes")), g.graph_edges(table(spark, folder, "standard_edges"))


KG = r"""WITH RECURSIVE
nr AS (SELECT *, lower(trim(id)) AS nid, CASE WHEN confidence > 0 AND confidence <= 1 AND NOT isnan(confidence) THEN confidence END AS c FROM standard_nodes WHERE trim(id) <> ''),
n AS (SELECT nid AS id,
  first(name ORDER BY row_id) FILTER (WHERE name IS NOT NULL) AS name,
  first(type ORDER BY row_id) FILTER (WHERE type IS NOT NULL) AS type,
  first(description ORDER BY length(description) DESC, row_id) FILTER (WHERE description IS NOT NULL) AS description,
  coalesce(max(c), 0.0) AS confidence, min(row_id) AS ord
  FROM nr GROUP BY nid),
er AS (SELECT row_id, id, lower(trim(source)) AS source, type, lower(trim(target)) AS target, evidence, CASE WHEN confidence > 0 AND confidence <= 1 AND NOT isnan(confidence) THEN confidence END AS c
  FROM standard_edges WHERE trim(source) <> '' AND trim(target) <> ''),
e AS (SELECT source, type, target, min(id) AS id, coalesce(max(c), 0.0) AS confidence,
  first(evidence ORDER BY length(evidence) DESC, row_id) FILTER (WHERE evidence IS NOT NULL) AS evidence, min(row_id) AS ord
  FROM er GROUP BY source, type, target),
adj AS (SELECT source AS id, target AS neighbour FROM e UNION SELECT target, source FROM e),
deg AS (SELECT id, count(*) AS degree FROM (SELECT source AS id FROM e UNION ALL SELECT target FROM e) GROUP BY id),
t AS (SELECT e.*, s.type AS source_type, d.type AS target_type FROM e LEFT JOIN n s ON s.id = e.source LEFT JOIN n d ON d.id = e.target),
xe AS (SELECT target AS owner, source AS example, type, confidence FROM t WHERE type IN ('demonstrates', 'uses_syntax', 'contains_structure') AND source_type = 'CodeExample'
  UNION ALL SELECT source, target, type, confidence FROM t WHERE type = 'has_code_example' AND target_type = 'CodeExample'),
xb AS (SELECT owner, example, min((CASE type WHEN 'has_code_example' THEN 0 WHEN 'demonstrates' THEN 1 WHEN 'uses_syntax' THEN 2 WHEN 'contains_structure' THEN 3 ELSE 9 END, -confidence)) AS best FROM xe GROUP BY owner, example),
xt AS (SELECT owner, example, row_number() OVER (PARTITION BY owner ORDER BY best, example) AS place FROM xb),
hot AS (SELECT id FROM deg ORDER BY degree DESC, id LIMIT 1)
"""
_STRIP = r"coalesce(regexp_replace({0}, '^[\s\x{{3000}}]+|[\s\x{{3000}}]+$', '', 'g'), '')"

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query of (nodes, edges) and its oracle over the views n, e, adj, deg, t, xt."""

    def put(f):
        def run(spark, folder):
            return f(spark, *_graph(spark, folder))

        run.__doc__ = f.__doc__
        QUERIES[name] = run
        if sql:
            SQL[name] = KG + sql
        return f

    return put


def _hot(spark, edges):
    """The node of the greatest degree, as a one-row DataFrame."""
    return g.degrees(edges).orderBy(F.desc("degree"), "id").limit(1).select("id")


@query("s12_nodes", "SELECT id, name, type, description, confidence FROM n")
def s12_nodes(spark, nodes, edges):
    return nodes.select("id", "name", "type", "description", "confidence")


@query("a5_edges", "SELECT id, source, target, type, confidence, evidence FROM e")
def a5_edges(spark, nodes, edges):
    return edges.select("id", "source", "target", "type", "confidence", "evidence")


@query("a1_degree", "SELECT id, degree FROM deg")
def a1_degree(spark, nodes, edges):
    return g.degrees(edges)


@query("a2_neighbours", "SELECT id, count(*) AS neighbours FROM adj GROUP BY id")
def a2_neighbours(spark, nodes, edges):
    return g.neighbour_counts(edges)


@query("q7_node_types", "SELECT type AS node_type, count(*) AS n FROM n GROUP BY type")
def q7_node_types(spark, nodes, edges):
    return nodes.groupBy(F.col("type").alias("node_type")).agg(F.count("*").alias("n"))


@query("q8_relation_types", "SELECT type AS relation_type, count(*) AS n FROM e GROUP BY type")
def q8_relation_types(spark, nodes, edges):
    return edges.groupBy(F.col("type").alias("relation_type")).agg(F.count("*").alias("n"))


@query("j1_endpoints", "SELECT source_type, type, target_type, count(*) AS n, max(confidence) AS confidence FROM t GROUP BY ALL")
def j1_endpoints(spark, nodes, edges):
    return g.with_endpoints(edges, nodes).groupBy("source_type", "type", "target_type").agg(F.count("*").alias("n"), F.max("confidence").alias("confidence"))


@query("j3_induced", "SELECT id, source, target FROM t WHERE source_type IN ('KnowledgePoint', 'KnowledgeUnit') AND target_type IN ('KnowledgePoint', 'KnowledgeUnit')")
def j3_induced(spark, nodes, edges):
    return g.induced(edges, nodes.where("type IN ('KnowledgePoint', 'KnowledgeUnit')")).select("id", "source", "target")


_TRIPLES = ", ".join(f"('{r}', '{h}', '{t}')" for r, (hs, ts) in RELATION_SCHEMA.items() for h in hs for t in ts)


@query("f10_schema_check", f"SELECT t.source, t.type, t.target, a.r IS NOT NULL AS valid FROM t LEFT JOIN (VALUES {_TRIPLES}) a(r, h, d) ON a.r = t.type AND a.h = t.source_type AND a.d = t.target_type")
def f10_schema_check(spark, nodes, edges):
    return g.schema_check(edges, nodes).select("source", "type", "target", "valid")


@query("m5_rejects", f"SELECT t.type, count(*) AS n FROM t LEFT JOIN (VALUES {_TRIPLES}) a(r, h, d) ON a.r = t.type AND a.h = t.source_type AND a.d = t.target_type WHERE a.r IS NULL GROUP BY t.type")
def m5_rejects(spark, nodes, edges):
    return g.schema_check(edges, nodes).where("NOT valid").groupBy("type").agg(F.count("*").alias("n"))


@query("g1_adjacency", "SELECT id, neighbour FROM adj")
def g1_adjacency(spark, nodes, edges):
    return g.adjacency(edges)


@query(
    "g2_within_two_hops",
    """, h1 AS (SELECT DISTINCT a.neighbour AS id FROM adj a JOIN hot USING (id)), h2 AS (SELECT DISTINCT a.neighbour AS id FROM adj a JOIN h1 USING (id))
SELECT id, min(hops)::BIGINT AS hops FROM (SELECT id, 0 AS hops FROM hot UNION ALL SELECT id, 1 FROM h1 UNION ALL SELECT id, 2 FROM h2) GROUP BY id""",
)
def g2_within_two_hops(spark, nodes, edges):
    return g.within_hops(edges, _hot(spark, edges), 2).select("id", F.col("hops").cast("bigint").alias("hops"))


@query(
    "g3_layers",
    """, h1 AS (SELECT DISTINCT a.neighbour AS id FROM adj a JOIN hot USING (id))
SELECT n.id, CASE WHEN n.id = (SELECT id FROM hot) THEN 1 WHEN n.id IN (SELECT id FROM h1) THEN 2 ELSE 3 END::BIGINT AS layer FROM n WHERE n.id IN (SELECT id FROM deg)""",
)
def g3_layers(spark, nodes, edges):
    ids = nodes.select("id").join(g.degrees(edges).select("id"), "id", "left_semi")
    focus = _hot(spark, edges).select(F.col("id").alias("focus"))
    near = g.adjacency(edges).join(F.broadcast(focus), F.col("neighbour") == F.col("focus")).select("id", F.lit(2).alias("beside"))
    rows = ids.join(near, "id", "left").join(F.broadcast(focus), F.col("id") == F.col("focus"), "left")
    return rows.select("id", F.when(F.col("focus").isNotNull(), 1).otherwise(F.coalesce("beside", F.lit(3))).cast("bigint").alias("layer"))


@query(
    "g4_overview",
    """, p AS (SELECT * FROM t WHERE type = 'part_of'), roots AS (SELECT id FROM n WHERE type = 'KnowledgeDomain'),
major AS (SELECT DISTINCT source AS id FROM p WHERE target IN (SELECT id FROM roots) AND source_type = 'KnowledgeUnit')
SELECT id, max(l)::BIGINT AS layer FROM (SELECT id, 1 AS l FROM roots UNION ALL SELECT id, 2 FROM major UNION ALL SELECT source, 3 FROM p WHERE target IN (SELECT id FROM major)) GROUP BY id""",
)
def g4_overview(spark, nodes, edges):
    return g.hierarchy_overview(nodes, edges, "KnowledgeDomain", "KnowledgeUnit").select("id", F.col("layer").cast("bigint").alias("layer"))


@query("w3_top_examples", "SELECT owner, example, place FROM xt WHERE place <= 12")
def w3_top_examples(spark, nodes, edges):
    return g.top_examples(edges, nodes).select("owner", "example", F.col("place").cast("bigint").alias("place"))


_SUPPORT = """, sup AS (SELECT id, source, target, confidence, CASE WHEN source_type = 'CodeExample' THEN source ELSE target END AS example, CASE WHEN source_type = 'CodeExample' THEN target ELSE source END AS support,
  CASE WHEN source_type = 'CodeExample' THEN target_type ELSE source_type END AS st FROM t WHERE type IN ('contains_structure', 'uses_syntax', 'appears_in_example', 'used_in_example') AND (source_type = 'CodeExample' OR target_type = 'CodeExample')),
sp AS (SELECT owner, sup.id, support, row_number() OVER (PARTITION BY owner ORDER BY confidence DESC, source, target, sup.id) AS place FROM xt JOIN sup USING (example) WHERE xt.place <= 12 AND st IN ('CodeStructure', 'SyntaxRule', 'ProgrammingLanguage'))
"""


@query("w4_support", _SUPPORT + "SELECT owner, id, support, place FROM sp WHERE place <= 20")
def w4_support(spark, nodes, edges):
    return g.support_edges(edges, nodes).select("owner", "id", "support", F.col("place").cast("bigint").alias("place"))


@query(
    "w5_example_home",
    """SELECT example, owner AS home FROM (SELECT example, owner, row_number() OVER (PARTITION BY example ORDER BY CASE n.type WHEN 'KnowledgePoint' THEN 0 WHEN 'KnowledgeUnit' THEN 1 ELSE 2 END, xe.confidence DESC, owner) AS k
FROM xe JOIN n ON n.id = owner WHERE n.type IN ('KnowledgePoint', 'KnowledgeUnit', 'KnowledgeDomain')) WHERE k = 1""",
)
def w5_example_home(spark, nodes, edges):
    return g.example_home(edges, nodes)


@query("w1_top_nodes", "SELECT id, degree, row_number() OVER (ORDER BY degree DESC, id) AS place FROM (SELECT n.id, coalesce(degree, 0) AS degree FROM n LEFT JOIN deg USING (id)) ORDER BY degree DESC, id LIMIT 500")
def w1_top_nodes(spark, nodes, edges):
    """The view's node limit: a top-k report over all nodes."""
    return g.visible_nodes(nodes.select("id"), edges, "", 500).select("id", "degree", F.col("place").cast("bigint").alias("place"))


def _point(spark, nodes, edges):
    """The point with an example whose id is least: the focus of the view queries."""
    row = g.top_examples(edges, nodes).select(F.col("owner").alias("id")).join(nodes.where("type = 'KnowledgePoint'").select("id"), "id", "left_semi").agg(F.min("id").alias("id")).first()
    return row.id if row and row.id else ""


_FOCUS = """, f AS (SELECT min(owner) AS id FROM xt JOIN n ON n.id = owner WHERE n.type = 'KnowledgePoint'),
fe AS (SELECT id, source, target, type FROM t, (SELECT id AS fid FROM f) WHERE type = 'part_of' AND (source = fid AND target_type = 'KnowledgeUnit' OR target = fid AND source_type = 'KnowledgeUnit')
  UNION SELECT t.id, t.source, t.target, t.type FROM t JOIN f ON t.source = f.id OR t.target = f.id JOIN xt ON xt.owner = f.id AND xt.place <= 12 AND (xt.example = t.source AND t.source_type = 'CodeExample' OR xt.example = t.target AND t.target_type = 'CodeExample')
    WHERE t.type IN ('has_code_example', 'demonstrates', 'uses_syntax', 'contains_structure')
  UNION SELECT t.id, t.source, t.target, t.type FROM t JOIN sp ON sp.id = t.id JOIN f ON sp.owner = f.id WHERE sp.place <= 20)
"""


@query("g5_focus_point", _SUPPORT + _FOCUS + "SELECT id, source, target, type FROM fe")
def g5_focus_point(spark, nodes, edges):
    return g.focus_edges(edges, nodes, _point(spark, nodes, edges)).select("id", "source", "target", "type")


@query(
    "g6_view",
    _SUPPORT
    + _FOCUS
    + """, fd AS (SELECT id, count(*) AS degree FROM (SELECT source AS id FROM fe UNION ALL SELECT target FROM fe) GROUP BY id)
SELECT n.id, n.type, degree FROM fd JOIN n USING (id) ORDER BY n.id = (SELECT id FROM f) DESC, degree DESC, n.id LIMIT 36""",
)
def g6_view(spark, nodes, edges):
    focus = _point(spark, nodes, edges)
    picked = g.focus_edges(edges, nodes, focus)
    ids = picked.select(F.explode(F.array("source", "target")).alias("id")).distinct()
    return g.visible_nodes(ids, picked, focus, 36).select("id", "degree").join(nodes.select("id", "type"), "id")


@query("g7_neighbours_of_all", "SELECT adj.id, adj.neighbour, n.type, n.confidence FROM adj JOIN n ON n.id = adj.neighbour")
def g7_neighbours_of_all(spark, nodes, edges):
    return g.adjacency(edges).join(nodes.select(F.col("id").alias("neighbour"), "type", "confidence"), "neighbour").select("id", "neighbour", "type", "confidence")


@query(
    "g19_paths",
    """, s AS (SELECT source, target, id AS eid FROM e WHERE type = 'prerequisite_of'),
w1 AS (SELECT source AS a, target AS z, [eid] AS used FROM s), w2 AS (SELECT a, target AS z, list_append(used, eid) AS used FROM w1 JOIN s ON z = source WHERE NOT list_contains(used, eid)),
w3 AS (SELECT a, target AS z, list_append(used, eid) AS used FROM w2 JOIN s ON z = source WHERE NOT list_contains(used, eid))
SELECT a AS start, z AS finish, len(used)::BIGINT AS length FROM (SELECT * FROM w1 UNION ALL SELECT * FROM w2 UNION ALL SELECT * FROM w3)""",
)
def g19_paths(spark, nodes, edges):
    return g.paths_between(edges, "prerequisite_of")


@query("f21_bridging_examples", "SELECT example, count(DISTINCT other) AS others FROM (SELECT source AS example, target AS other FROM t WHERE source_type = 'CodeExample' AND target_type <> 'CodeExample' UNION ALL SELECT target, source FROM t WHERE target_type = 'CodeExample' AND source_type <> 'CodeExample') GROUP BY example HAVING count(DISTINCT other) >= 2")
def f21_bridging_examples(spark, nodes, edges):
    return g.bridging_examples(edges, nodes)


def _case(column: str, groups, other: str) -> str:
    return "CASE " + " ".join(f"WHEN lower({column}) IN ({', '.join(repr(x) for x in names)}) THEN '{shown}'" for shown, names in groups.items()) + f" ELSE '{other}' END"


@query(
    "t18_shown_nodes",
    f"""SELECT n.id, CASE WHEN type = 'CodeExample' AND (lower(l) LIKE 'codeexample%' OR length(l) > 28) THEN
    CASE WHEN d <> '' AND d NOT IN ('教学材料中的代码示例', '代码示例') THEN '示例 · ' || substr(d, 1, 18) || CASE WHEN length(d) > 18 THEN '…' ELSE '' END ELSE '代码示例 · ' || right(l, 10) END ELSE l END AS label,
  {_case("type", SHOWN_NODE_TYPES, "concept")} AS shown_type, type AS source_type, 54 + least(coalesce(degree, 0), 8) * 5 AS size, confidence, coalesce(degree, 0) AS relation_count, d AS summary,
  CASE WHEN type IN ({", ".join(repr(x) for x in EXPANDABLE_TYPES)}) THEN n.id END AS children
FROM (SELECT *, {_STRIP.format("description")} AS d, CASE WHEN {_STRIP.format("name")} <> '' THEN {_STRIP.format("name")} ELSE id END AS l FROM n) n LEFT JOIN deg USING (id)""",
)
def t18_shown_nodes(spark, nodes, edges):
    return g.shown_nodes(nodes, edges)


@query(
    "t19_shown_edges",
    f"""SELECT id, CASE WHEN type = 'part_of' THEN target ELSE source END AS source, CASE WHEN type = 'part_of' THEN source ELSE target END AS target,
  CASE lower(type) {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EDGE_LABELS.items())} ELSE '关联关系' END AS label, {_case("type", SHOWN_EDGE_TYPES, "related")} AS shown_type,
  greatest(45, least(95, round_even(confidence * 100, 0)))::BIGINT AS strength FROM e""",
)
def t19_shown_edges(spark, nodes, edges):
    return g.shown_edges(edges)


@query("f12_search", f"SELECT id, type FROM n WHERE contains(lower(concat_ws(' ', id, name, type, {_STRIP.format('description')})), '索引树') ORDER BY ord LIMIT 12")
def f12_search(spark, nodes, edges):
    """A search box: the first twelve hits in table order."""
    hay = F.lower(F.concat_ws(" ", "id", "name", "type", F.coalesce(F.regexp_replace("description", r"(?U)^[\s　]+|[\s　]+$", ""), F.lit(""))))
    return nodes.where(F.contains(hay, F.lit("索引树"))).orderBy("ord").limit(12).select("id", "type")


@query("q9_one_hop", "SELECT adj.neighbour AS id FROM adj JOIN hot USING (id)")
def q9_one_hop(spark, nodes, edges):
    return g.adjacency(edges).join(F.broadcast(_hot(spark, edges)), "id", "left_semi").select(F.col("neighbour").alias("id"))


@query("q3_syntax_points", "SELECT source, target, type FROM t WHERE type IN ('expresses_concept', 'has_syntax') AND (source_type = 'SyntaxRule' AND target_type = 'KnowledgePoint' OR source_type = 'KnowledgePoint' AND target_type = 'SyntaxRule')")
def q3_syntax_points(spark, nodes, edges):
    typed = g.with_endpoints(edges, nodes).where("type IN ('expresses_concept', 'has_syntax')")
    return typed.where("source_type = 'SyntaxRule' AND target_type = 'KnowledgePoint' OR source_type = 'KnowledgePoint' AND target_type = 'SyntaxRule'").select("source", "target", "type")


@query("q10_evidence", "SELECT id, evidence FROM e WHERE evidence IS NOT NULL AND type = 'has_code_example'")
def q10_evidence(spark, nodes, edges):
    return edges.where("evidence IS NOT NULL AND type = 'has_code_example'").select("id", "evidence")


@query("q19_counts", "SELECT (SELECT count(DISTINCT id) FROM n) AS nodes, (SELECT count(*) FROM e) AS relationships")
def q19_counts(spark, nodes, edges):
    return nodes.agg(F.countDistinct("id").alias("nodes")).crossJoin(edges.agg(F.count("*").alias("relationships")))


@query(
    "a18_health",
    """SELECT (SELECT count(*) FROM n) AS nodes, (SELECT count(*) FROM e) AS edges, (SELECT count(*) FROM e WHERE source NOT IN (SELECT id FROM n) OR target NOT IN (SELECT id FROM n)) AS invalid_edges,
  (SELECT count(*) FROM e WHERE source = target AND source IN (SELECT id FROM n)) AS self_loops,
  (SELECT count(*) FROM n WHERE id NOT IN (SELECT id FROM deg)) AS isolated_nodes""",
)
def a18_health(spark, nodes, edges):
    return g.integrity(nodes, edges)


@query("a19_schema", "SELECT 'node' AS kind, type FROM n UNION SELECT 'edge', type FROM e")
def a19_schema(spark, nodes, edges):
    return nodes.select(F.lit("node").alias("kind"), "type").unionByName(edges.select(F.lit("edge").alias("kind"), "type")).distinct()


@query("a17_layers", "SELECT type, count(*) AS n, max(confidence) AS confidence, count_if(confidence >= 0.85)::BIGINT AS sure FROM n GROUP BY type")
def a17_layers(spark, nodes, edges):
    return nodes.groupBy("type").agg(F.count("*").alias("n"), F.max("confidence").alias("confidence"), F.count_if(F.col("confidence") >= 0.85).alias("sure"))


@query("v2_parents", "SELECT source AS id, count(*) AS parents FROM e WHERE type = 'part_of' GROUP BY source HAVING count(*) <> 1")
def v2_parents(spark, nodes, edges):
    return edges.where("type = 'part_of'").groupBy(F.col("source").alias("id")).agg(F.count("*").alias("parents")).where("parents <> 1")


@query("v3_example_leaves", "SELECT id, source, type FROM t WHERE source_type = 'CodeExample'")
def v3_example_leaves(spark, nodes, edges):
    return g.with_endpoints(edges, nodes).where("source_type = 'CodeExample'").select("id", "source", "type")


@query("u3_visible_ids", "SELECT id FROM n WHERE type = 'KnowledgeDomain' UNION SELECT source FROM e WHERE type = 'part_of' UNION SELECT target FROM e WHERE type = 'part_of'")
def u3_visible_ids(spark, nodes, edges):
    part = edges.where("type = 'part_of'")
    return nodes.where("type = 'KnowledgeDomain'").select("id").union(part.select("source")).union(part.select("target")).distinct()


@query("u4_unlinked", "SELECT id FROM n EXCEPT SELECT id FROM deg")
def u4_unlinked(spark, nodes, edges):
    return nodes.select("id").join(g.degrees(edges).select("id"), "id", "left_anti")


@query("t31_shared_names", "SELECT name, count(*) AS n FROM n WHERE name IS NOT NULL GROUP BY name HAVING count(*) >= 2")
def t31_shared_names(spark, nodes, edges):
    return nodes.where("name IS NOT NULL").groupBy("name").agg(F.count("*").alias("n")).where("n >= 2")


def _catalog_tree(spark, folder):
    rows = table(spark, folder, "curriculum_catalog").select("id", "parent_id", F.lit(None).cast("timestamp").alias("updated_at"), F.lit(None).cast("timestamp").alias("ingested_at"))
    return resolve_hierarchy(rows)


def g8_ancestors(spark, folder):
    """Every catalog node with each of its ancestors, itself included."""
    tree = _catalog_tree(spark, folder)
    above = descendants(tree).select(F.col("descendant").alias("id"), F.col("id").alias("ancestor"), F.col("distance").cast("bigint").alias("distance"))
    return above.unionByName(tree.select("id", F.col("id").alias("ancestor"), F.lit(0).cast("bigint").alias("distance")))


def v1_tree(spark, folder):
    """The checks of the catalog as one row of counts."""
    rows = table(spark, folder, "curriculum_catalog")
    ids = rows.select(F.col("id").alias("parent_id")).distinct()
    orphans = rows.where("id <> 'ROOT'").join(ids, "parent_id", "left_anti").agg(F.count("*").alias("orphans"))
    loops = _catalog_tree(spark, folder).agg(F.count_if(F.col("cycle_id").isNotNull()).alias("in_loops"))
    basic = rows.agg(F.count("*").alias("nodes"), F.countDistinct("id").alias("ids"), F.count_if(F.col("id") == "ROOT").alias("roots"), F.count_if((F.col("id") == "ROOT") & (F.coalesce("parent_id", F.lit("")) != "")).alias("rooted_wrongly"))
    return basic.crossJoin(orphans).crossJoin(loops)


def c15_aliases(spark, folder):
    """Every alias of every node."""
    return g.node_aliases(table(spark, folder, "standard_nodes"))


QUERIES |= {"c15_aliases": c15_aliases, "g8_ancestors": g8_ancestors, "v1_tree": v1_tree}
SQL |= {
    "c15_aliases": f"SELECT DISTINCT id, a AS alias FROM (SELECT lower(trim(id)) AS id, {_STRIP.format('a')} AS a FROM (SELECT id, unnest(aliases) AS a FROM standard_nodes)) WHERE id <> '' AND a <> ''",
    "g8_ancestors": "WITH RECURSIVE up AS (SELECT id, id AS ancestor, 0::BIGINT AS distance FROM curriculum_catalog UNION ALL SELECT u.id, c.parent_id, u.distance + 1 FROM up u JOIN curriculum_catalog c ON c.id = u.ancestor WHERE c.parent_id IN (SELECT id FROM curriculum_catalog)) SELECT * FROM up",
    "v1_tree": "SELECT count(*) AS nodes, count(DISTINCT id) AS ids, count_if(id = 'ROOT')::BIGINT AS roots, count_if(id = 'ROOT' AND coalesce(parent_id, '') <> '')::BIGINT AS rooted_wrongly, (SELECT count(*) FROM curriculum_catalog WHERE id <> 'ROOT' AND parent_id NOT IN (SELECT id FROM curriculum_catalog)) AS orphans, 0::BIGINT AS in_loops FROM curriculum_catalog",
}
