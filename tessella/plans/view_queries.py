"""View, audit and remaining projection queries, with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessella.operators import extraction as x
from tessella.operators import graph as g
from tessella.operators import views as v
from tessella.plans.graph_queries import KG, _STRIP, _TRIPLES
from tessella.plans.question_queries import QQ, _questions
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


@query("w2_trimmed")
def w2_trimmed(spark, folder):
    """The trimmed edges of the view of every knowledge domain; an order-dependent fold, tested against a plain one.

    A view holds the domain, then the best-linked of its neighbours, 36 nodes
    in all; its candidate edges are those between them.
    """
    nodes, edges = _graph(spark, folder)
    domains = nodes.where("type = 'KnowledgeDomain'").select(F.col("id").alias("view"))
    around = g.adjacency(edges).join(domains, F.col("id") == F.col("view")).select("view", F.col("neighbour").alias("id"))
    members = around.unionByName(domains.select("view", F.col("view").alias("id"))).distinct().join(nodes.select("id"), "id", "left_semi")
    order = Window.partitionBy("view").orderBy((F.col("id") == F.col("view")).desc(), F.desc("degree"), "id")
    top = members.join(g.degrees(edges), "id").withColumn("place", F.row_number().over(order)).where("place <= 36").select("id", "view")
    side = lambda c: top.select(F.col("id").alias(c), "view")
    return v.trimmed_edges(edges.join(side("source"), "source").join(side("target"), ["target", "view"]), "view")


@query("v5_acyclic", KG + ", s AS (SELECT DISTINCT source, target FROM e WHERE type = 'prerequisite_of'), rc AS (SELECT source AS a, target AS z FROM s UNION SELECT rc.a, s.target FROM rc JOIN s ON rc.z = s.source) SELECT s.source, s.target FROM s WHERE (s.source IN (SELECT rc.z FROM rc JOIN rc b ON b.a = rc.a AND b.z = rc.a) OR EXISTS (SELECT 1 FROM rc WHERE a = s.source AND z = s.source)) AND (EXISTS (SELECT 1 FROM rc WHERE a = s.target AND z = s.target) OR EXISTS (SELECT 1 FROM rc JOIN rc b ON b.a = rc.z AND b.z = rc.z WHERE rc.a = s.target))")
def v5_acyclic(spark, folder):
    """What keeps prerequisites from being acyclic."""
    return v.cyclic_part(_graph(spark, folder)[1].where("type = 'prerequisite_of'"))


@query("k12_triples", KG + """SELECT '<kg:' || regexp_replace(id, '[<>"{}|\\\\^`\\s]', '_', 'g') || '>' AS subject, predicate, object FROM (SELECT id, 'name' AS predicate, '"' || replace(replace(coalesce(name, ''), '\\', '\\\\'), '"', '\\"') || '"' AS object FROM n UNION ALL SELECT id, 'type', '"' || coalesce(type, '') || '"' FROM n)
UNION ALL SELECT '<kg:' || regexp_replace(source, '[<>"{}|\\\\^`\\s]', '_', 'g') || '>', type, '<kg:' || regexp_replace(target, '[<>"{}|\\\\^`\\s]', '_', 'g') || '>' FROM e""")
def k12_triples(spark, folder):
    return v.triples(*_graph(spark, folder))


@query("t21_shown_questions", f"WITH {QQ} SELECT question_id AS id, stem AS label, type, len(list_distinct(options))::BIGINT AS options, len(list_distinct(abilities))::BIGINT AS abilities, nullif(answer, '') AS answer FROM qq")
def t21_shown_questions(spark, folder):
    return _questions(spark, folder).select(F.col("question_id").alias("id"), F.col("stem").alias("label"), "type", F.size("options").cast("bigint").alias("options"), F.size("abilities").cast("bigint").alias("abilities"), F.nullif("answer", F.lit("")).alias("answer"))


@query("f11_allowed", f"SELECT h AS source_type, d AS target_type, string_agg(r, ' ' ORDER BY r) AS relations FROM (VALUES {_TRIPLES}) a(r, h, d) GROUP BY h, d")
def f11_allowed(spark, folder):
    """Which relations the schema allows between each pair of types."""
    return g.schema_triples(spark).groupBy("source_type", "target_type").agg(F.array_join(F.array_sort(F.collect_list("type")), " ").alias("relations"))


@query("a8_report", KG + f"SELECT count(*) AS edges, count_if(a.r IS NOT NULL)::BIGINT AS valid, count_if(t.confidence >= 0.85)::BIGINT AS sure, round(count_if(a.r IS NOT NULL)::DOUBLE / count(*), 6) AS valid_rate FROM t LEFT JOIN (VALUES {_TRIPLES}) a(r, h, d) ON a.r = t.type AND a.h = t.source_type AND a.d = t.target_type")
def a8_report(spark, folder):
    nodes, edges = _graph(spark, folder)
    rows = g.schema_check(edges, nodes)
    return rows.agg(F.count("*").alias("edges"), F.count_if("valid").alias("valid"), F.count_if(F.col("confidence") >= 0.85).alias("sure"), F.round(F.count_if("valid") / F.count("*"), 6).alias("valid_rate"))


_C = "CASE WHEN {0} = 'KnowledgePoint' THEN 'OOPConcept' ELSE {0} END"


@query(
    "g13_repaired",
    KG
    + f""", x AS (SELECT source AS h, {_C.format("source_type")} AS ht, type AS r, target AS t, {_C.format("target_type")} AS tt FROM t),
y AS (SELECT *, coalesce(r = 'belongs_to_paradigm' AND ht = 'ProgrammingParadigm' AND tt = 'OOPConcept' OR r = 'belongs_to_paradigm' AND ht = 'ProgrammingLanguage' AND tt = 'ProgrammingParadigm'
  OR r = 'has_code_structure' AND ht = 'OOPConcept' AND tt = 'OOPConcept' OR r = 'has_syntax' AND ht = 'SyntaxRule' AND tt = 'OOPConcept', false) AS turn,
  CASE WHEN r = 'part_of' AND ht = 'OOPConcept' AND tt = 'ProgrammingParadigm' THEN 'belongs_to_paradigm' WHEN r = 'part_of' AND ht = 'OOPConcept' AND tt = 'ProgrammingLanguage' THEN 'implemented_in'
  WHEN r = 'belongs_to_paradigm' AND ht = 'ProgrammingLanguage' AND tt = 'ProgrammingParadigm' THEN 'implemented_in' WHEN r IN ('has_code_structure', 'expresses_concept') AND ht = 'OOPConcept' AND tt = 'OOPConcept' THEN 'part_of' ELSE r END AS nr FROM x)
SELECT CASE WHEN turn THEN t ELSE h END AS head, nr AS relation, CASE WHEN turn THEN h ELSE t END AS tail FROM y""",
)
def g13_repaired(spark, folder):
    """Edges turned where their direction contradicts their types; points stand for concepts."""
    nodes, edges = _graph(spark, folder)
    as_concept = lambda c: F.when(F.col(c).isin("KnowledgePoint"), "OOPConcept").otherwise(F.col(c)).alias(f"{c[:6].replace('source', 'head').replace('target', 'tail')}_type")
    rows = g.with_endpoints(edges, nodes)
    relations = rows.select(F.col("source").alias("head"), as_concept("source_type"), F.col("type").alias("relation"), F.col("target").alias("tail"), as_concept("target_type"))
    return x.repaired(relations).select("head", "relation", "tail")


@query("q2_named_network", KG + "SELECT t.id, t.source, t.target FROM t JOIN n s ON s.id = t.source JOIN n d ON d.id = t.target WHERE s.type = 'KnowledgePoint' AND d.type = 'KnowledgePoint' AND (contains(coalesce(s.name, ''), '索引树') OR contains(coalesce(d.name, ''), '索引树'))")
def q2_named_network(spark, folder):
    nodes, edges = _graph(spark, folder)
    points = nodes.where("type = 'KnowledgePoint'").select("id", F.contains(F.coalesce("name", F.lit("")), F.lit("索引树")).alias("hit"))
    side = lambda c: points.select(F.col("id").alias(c), F.col("hit").alias(f"{c}_hit"))
    return edges.join(side("source"), "source").join(side("target"), "target").where("source_hit OR target_hit").select("id", "source", "target")


@query("q5_confused", KG + "SELECT source AS a, target AS b FROM t WHERE type = 'confused_with' AND source_type = target_type UNION SELECT target, source FROM t WHERE type = 'confused_with' AND source_type = target_type")
def q5_confused(spark, folder):
    """What is confused with what, in both directions."""
    nodes, edges = _graph(spark, folder)
    rows = g.with_endpoints(edges, nodes).where("type = 'confused_with' AND source_type = target_type")
    return rows.select(F.col("source").alias("a"), F.col("target").alias("b")).union(rows.select("target", "source")).distinct()
