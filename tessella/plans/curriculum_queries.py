"""Curriculum and remaining graph-building queries, with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.operators import curriculum as cu
from tessella.operators import graph as g
from tessella.operators import questions as q
from tessella.operators import resolution as r
from tessella.plans.graph_queries import KG, _TRIPLES, g8_ancestors
from tessella.plans.question_queries import QQ
from tessella.runtime import table

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


_KEY = "regexp_replace(lower(coalesce({0}, '')), '[\\s_\\-·.。,:：;；()（）\\[\\]【】{{}}<>《》/\\\\]+', '', 'g')"
IX = f"ix AS (SELECT key, min(id) AS id FROM (SELECT id, {_KEY.format('v')} AS key FROM (SELECT id, unnest(list_concat([name], coalesce(aliases, []), coalesce(keywords, []))) AS v FROM curriculum_catalog)) WHERE key <> '' GROUP BY key)"


@query("g10_alias_index", f"WITH {IX} SELECT key, id FROM ix")
def g10_alias_index(spark, folder):
    return cu.alias_index(table(spark, folder, "curriculum_catalog"))


_CHUNK = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id) AS k FROM clean_chunks) WHERE k = 1)"


@query(
    "g9_text_matches",
    f"""WITH {IX}, c AS (SELECT chunk_id, {_KEY.format("content")} AS t FROM {_CHUNK}),
h AS (SELECT chunk_id, id, max(length(key)) AS length FROM c JOIN ix ON length(key) >= 2 AND contains(t, key) GROUP BY ALL)
SELECT * FROM (SELECT chunk_id, id, length, row_number() OVER (PARTITION BY chunk_id ORDER BY length DESC, id) AS place FROM h) WHERE place <= 12""",
)
def g9_text_matches(spark, folder):
    return cu.text_matches(table(spark, folder, "clean_chunks").dropDuplicates(["chunk_id"]), "chunk_id", "content", table(spark, folder, "curriculum_catalog"))


_PLACED = f"""{IX}, pl AS (SELECT n.id, n.type, ix.id AS catalog_id, ix.id IS NULL AND coalesce(n.type IN ('KnowledgeDomain', 'KnowledgeUnit', 'KnowledgePoint'), false) AS candidate FROM n LEFT JOIN ix ON ix.key = {_KEY.format("n.name")}),
pn AS (SELECT *, CASE WHEN catalog_id IS NOT NULL THEN 'curriculum_' || catalog_id WHEN NOT candidate THEN id END AS new_id FROM pl)"""


@query("j14_placed", f"{KG}, {_PLACED} SELECT id, new_id, catalog_id, candidate FROM pn")
def j14_placed(spark, folder):
    return cu.placed(_graph(spark, folder)[0], table(spark, folder, "curriculum_catalog"))


_UP = """up AS (SELECT id, id AS ancestor FROM curriculum_catalog UNION ALL SELECT u.id, c.parent_id FROM up u JOIN curriculum_catalog c ON c.id = u.ancestor WHERE c.parent_id IN (SELECT id FROM curriculum_catalog)),
di AS (SELECT DISTINCT catalog_id AS id FROM pn WHERE catalog_id IS NOT NULL), cv AS (SELECT DISTINCT ancestor AS id FROM up WHERE id IN (SELECT id FROM di)),
en AS (SELECT 'curriculum_' || c.id AS id, c.name, c.type, CASE WHEN c.id IN (SELECT id FROM di) THEN 'direct' ELSE 'structural' END AS coverage, CASE WHEN c.id IN (SELECT id FROM di) THEN 0.98 ELSE 0.9 END::DOUBLE AS confidence FROM curriculum_catalog c WHERE c.id IN (SELECT id FROM cv)
  UNION ALL SELECT n.id, n.name, n.type, 'direct', n.confidence FROM n JOIN pn ON pn.id = n.id WHERE pn.catalog_id IS NULL AND NOT candidate)"""


@query("g17_nodes", f"{KG}, {_PLACED}, {_UP} SELECT * FROM en")
def g17_nodes(spark, folder):
    return cu.enriched_nodes(_graph(spark, folder)[0], table(spark, folder, "curriculum_catalog"), g8_ancestors(spark, folder))


@query(
    "g17_edges",
    f"""{KG}, {_PLACED}, {_UP}, ee AS (SELECT s.new_id AS source, e.type, d.new_id AS target, max(e.confidence) AS confidence FROM e JOIN pn s ON s.id = e.source JOIN pn d ON d.id = e.target WHERE e.type <> 'part_of' AND s.new_id IS NOT NULL AND d.new_id IS NOT NULL GROUP BY ALL
  UNION ALL SELECT 'curriculum_' || id, 'part_of', 'curriculum_' || parent_id, 1.0 FROM curriculum_catalog WHERE id <> 'ROOT' AND 'curriculum_' || id IN (SELECT id FROM en) AND 'curriculum_' || parent_id IN (SELECT id FROM en))
SELECT source, type, target, confidence, 'edge_' || substr(sha256(source || ':' || type || ':' || target), 1, 16) AS id FROM ee""",
)
def g17_edges(spark, folder):
    return cu.enriched_edges(*reversed(_graph(spark, folder)), table(spark, folder, "curriculum_catalog"), g8_ancestors(spark, folder))


@query("g16_edges", KG + f"SELECT t.id, t.source, t.type, t.target, t.confidence FROM t JOIN (VALUES {_TRIPLES}) a(r, h, d) ON a.r = t.type AND a.h = t.source_type AND a.d = t.target_type WHERE t.source <> t.target AND t.confidence >= 0.6")
def g16_edges(spark, folder):
    nodes, edges = _graph(spark, folder)
    return g.schema_check(edges, nodes).where("valid AND source <> target AND confidence >= 0.6").select("id", "source", "type", "target", "confidence")


@query("j4_missing_ends", KG + "SELECT x.id, max(x.confidence) AS confidence FROM (SELECT source AS id, confidence FROM e UNION ALL SELECT target, confidence FROM e) x WHERE x.id NOT IN (SELECT id FROM n WHERE type <> 'Skill') GROUP BY x.id")
def j4_missing_ends(spark, folder):
    """Ends of edges that no node but a skill stands for."""
    nodes, edges = _graph(spark, folder)
    ends = edges.select(F.explode(F.array("source", "target")).alias("id"), "confidence")
    return ends.join(nodes.where("type <> 'Skill'").select("id"), "id", "left_anti").groupBy("id").agg(F.max("confidence").alias("confidence"))


@query("a15_import_report", f"WITH {QQ} SELECT (SELECT count(*) FROM qq) AS questions, (SELECT count(DISTINCT type) FROM qq) AS types, (SELECT count(DISTINCT difficulty) FROM qq) AS difficulties, (SELECT count(DISTINCT a) FROM (SELECT unnest(abilities) AS a FROM qq)) AS abilities")
def a15_import_report(spark, folder):
    rows = q.normalized(table(spark, folder, "questions"))
    kinds = rows.select(F.explode_outer("abilities").alias("a")).agg(F.countDistinct("a").alias("abilities"))
    return rows.agg(F.count("*").alias("questions"), F.countDistinct("type").alias("types"), F.countDistinct("difficulty").alias("difficulties")).crossJoin(kinds)


@query("j8_similar_names")
def j8_similar_names(spark, folder):
    """Names of one type that are nearly alike; tested against brute force, as SQL has no such ratio."""
    return r.similar_names(table(spark, folder, "prepared_entities"))
