"""Report, decision and demonstration queries, with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella import sinks
from tessella.operators import decisions as d
from tessella.operators import extraction as x
from tessella.operators import graph as g
from tessella.operators import questions as q
from tessella.operators import reports as rp
from tessella.operators import views as v
from tessella.plans.graph_queries import KG, _STRIP, _TRIPLES
from tessella.plans.question_queries import _EVAL, _KEYWORDS, _LABEL, _LEVEL, _LINKED, QQ, _links, _questions, _t
from tessella.plans.relation_queries import _CHECKED, _ENTITIES, _RELATIONS, _SCORE, _SEEN
from tessella.plans.text_queries import CHUNKS, _chunks
from tessella.runtime import table
from tessella.vocabulary import NODE_TYPES

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


def _aliases(spark, folder):
    return g.node_aliases(table(spark, folder, "standard_nodes"))


# ---------------------------------------------------------------- decisions


@query("f16_needs_model", f"WITH {_SEEN} SELECT c.chunk_id, NOT (len(h.concepts) > 0 OR len(h.syntax) > 0 OR EXISTS (SELECT 1 FROM de WHERE de.chunk_id = c.chunk_id AND de.ex IS NOT NULL) OR EXISTS (SELECT 1 FROM li WHERE li.chunk_id = c.chunk_id)) OR CASE WHEN c.confidence_hint IS NULL OR isnan(c.confidence_hint) THEN 0.0 ELSE greatest(0.0, least(1.0, c.confidence_hint)) END < 0.75 AS needed FROM {CHUNKS} c JOIN ch h USING (chunk_id)")
def f16_needs_model(spark, folder):
    """Which chunks rules alone can't settle."""
    chunks = _chunks(spark, folder)
    found = x.rule_entities(chunks).where(F.col("type").isin("OOPConcept", "SyntaxRule", "CodeStructure")).select("chunk_id").distinct().withColumn("found", F.lit(True))
    return chunks.select("chunk_id", "confidence_hint").join(found, "chunk_id", "left").select("chunk_id", d.chunk_needs_model(F.col("found"), F.col("confidence_hint")).alias("needed"))


def _candidates(spark, folder, most=12):
    nodes, edges = _graph(spark, folder)
    return q.candidates(_questions(spark, folder), nodes, _aliases(spark, folder), edges, most)


@query("f17_needs_model", f"{KG}, {QQ}, {_LINKED} SELECT question_id, count(*) = 2 AND coalesce(NOT (max(score) FILTER (WHERE place = 1) >= 5 AND max(score) FILTER (WHERE place = 1) - max(score) FILTER (WHERE place = 2) >= 2), false) AS needed FROM cand WHERE place <= 2 GROUP BY question_id")
def f17_needs_model(spark, folder):
    """Which questions have candidates too close to call."""
    return d.questions_needing_model(_candidates(spark, folder))


@query("f18_accepted", f"SELECT DISTINCT m.match_id FROM entity_matches m JOIN (SELECT raw_id, min(type) AS type FROM prepared_entities GROUP BY raw_id) p ON p.raw_id = m.left_id WHERE m.verdict = 'same' AND NOT isnan(m.score) AND m.score >= 0.85 AND p.type IN ({', '.join(repr(n) for n in NODE_TYPES)})")
def f18_accepted(spark, folder):
    """Match decisions that are sure enough and name a known type."""
    kinds = table(spark, folder, "prepared_entities").groupBy("raw_id").agg(F.min("type").alias("type"))
    rows = table(spark, folder, "entity_matches").select("match_id", F.col("left_id").alias("raw_id"), (F.col("verdict") == "same").alias("merge"), "score").join(kinds, "raw_id")
    return rows.where(d.accepted_merge(F.col("merge"), F.col("score"), F.col("type"))).select("match_id").distinct()


@query("m8_reviewed", KG + f", k AS (SELECT *, row_number() OVER (ORDER BY id) % 4 AS a FROM t), r AS (SELECT k.*, CASE WHEN a = 0 THEN 'action' WHEN confidence < 0.75 THEN 'confidence' WHEN v.r IS NULL THEN 'type' END AS reason FROM k LEFT JOIN (VALUES {_TRIPLES}) v(r, h, d) ON v.r = lower(k.type) AND v.h = k.source_type AND v.d = k.target_type) SELECT id, CASE WHEN a = 3 THEN NULL ELSE reason END AS reason, CASE WHEN a = 3 OR reason IS NOT NULL THEN type ELSE lower(type) END AS new_type FROM r")
def m8_reviewed(spark, folder):
    """Edges after a review; here every fourth has no decision, every fourth is doubted."""
    nodes, edges = _graph(spark, folder)
    from pyspark.sql.window import Window

    numbered = edges.select("id", "type", "confidence").withColumn("a", F.row_number().over(Window.orderBy("id")) % 4)
    made = numbered.where("a <> 3").select("id", F.when(F.col("a") == 0, "doubt").when(F.col("a") == 1, "Keep").otherwise("repair").alias("action"), F.upper("type").alias("relation_type"), "confidence", F.lit(1).alias("ord"))
    return d.reviewed_relations(g.with_endpoints(edges, nodes), made).select("id", "reason", "new_type")


def _answers(spark, folder):
    """The gold points of each question, backwards, in the place of a model's answers."""
    gold = _questions(spark, folder).select("question_id", F.posexplode(F.reverse("gold")).alias("at", "p"))
    return gold.select("question_id", "at", "p.name", "p.role", F.lit(None).cast("double").alias("confidence"))


@query(
    "w8_model_links",
    f"""{KG}, {QQ}, {_LINKED}, an AS (SELECT question_id, p.name, min(i) AS at, first(p.role ORDER BY i) AS role FROM (SELECT question_id, unnest(list_reverse(g)) AS p, generate_subscripts(list_reverse(g), 1) AS i FROM (SELECT question_id, list_filter(gold, lambda y, j: list_position(gold, y) = j) AS g FROM qq)) GROUP BY question_id, p.name),
ow AS (SELECT an.question_id, an.name, c.id, an.role, 0.6::DOUBLE AS confidence, row_number() OVER (PARTITION BY an.question_id ORDER BY an.at, an.name) AS place FROM an JOIN (SELECT * FROM cand WHERE place <= 12) c ON c.question_id = an.question_id AND c.name = an.name)
SELECT * FROM ow WHERE place <= 5 UNION ALL SELECT * FROM link WHERE question_id NOT IN (SELECT question_id FROM ow)""",
)
def w8_model_links(spark, folder):
    """Links as a model answers, only among the candidates, else those of the rules."""
    found = _candidates(spark, folder)
    return d.model_links(_answers(spark, folder), found, q.rule_links(found)).withColumn("place", F.col("place").cast("bigint"))


@query("f15_approved", f"WITH {QQ} SELECT question_id FROM qq WHERE answer <> ''")
def f15_approved(spark, folder):
    """Questions that may be used: here all answers are given ones."""
    rows = _questions(spark, folder)
    source = F.when(F.col("answer") != "", "provided").otherwise("missing")
    return rows.where(d.approved(source, F.col("answer"), F.lit(None).cast("string"), F.lit(None).cast("double"))).select("question_id")


@query("a16_answers", f"WITH {QQ} SELECT CASE WHEN answer <> '' THEN 'verified' ELSE 'needs_generation' END AS answer_status, language, count(*) AS n FROM qq GROUP BY ALL")
def a16_answers(spark, folder):
    """How many questions of each language have an answer, before any model is asked."""
    rows = _questions(spark, folder)
    none = rows.limit(0)
    generated = none.select("question_id", F.lit("").alias("answer_kind"), "answer", "analysis", F.lit(0.0).alias("confidence"))
    verified = none.select("question_id", F.lit(True).alias("accepted"), "answer", "analysis", F.lit(0.0).alias("confidence"))
    done = d.completed_answers(rows, generated, verified)
    return done.join(rows.select("question_id", "language"), "question_id").groupBy("answer_status", "language").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- reports

_EX = "list_filter(list_transform(coalesce(sources, []), lambda s: " + _t("s.content") + "), lambda c: c <> '')"
_EXL = "lower(array_to_string(list_transform(coalesce(sources, []), lambda s: coalesce(s.source_file, '') || ' ' || coalesce(s.content, '')), ' '))"
_has = lambda *ws: "(" + " OR ".join(f"contains(w, '{w}')" for w in ws) + ")"
_LANGUAGE = f"CASE WHEN {_has('java', 'system.out', 'public class')} THEN 'Java' WHEN {_has('python', 'def ', 'print(')} THEN 'Python' WHEN {_has('c++', '#include', 'std::', 'cout')} THEN 'C++' ELSE '通用编程' END"
_EXPORT = f"xp AS (SELECT row_id, id, title, code, {_LANGUAGE} AS language, title <> '' AND code <> '' AS complete FROM (SELECT row_id, coalesce(id, '') AS id, coalesce(name, '') AS title, array_to_string(list_filter(cs, lambda c, i: list_position(cs, c) = i), chr(10) || chr(10)) AS code, w FROM (SELECT *, {_EX} AS cs, {_EXL} AS w FROM (SELECT DISTINCT ON (row_id) * FROM standard_nodes WHERE type = 'CodeExample'))))"


def _examples(spark, folder):
    return rp.exported_examples(table(spark, folder, "standard_nodes").dropDuplicates(["row_id"]))


@query("k11_exported", f"WITH {_EXPORT} SELECT row_id, id, title, md5(code) AS digest, language, complete FROM xp")
def k11_exported(spark, folder):
    """Code examples with code, language and whether they are complete."""
    return _examples(spark, folder).select("row_id", "id", "title", F.md5(F.col("code").cast("binary")).alias("digest"), "language", "complete")


@query("a16_languages", f"WITH {_EXPORT} SELECT language, count(*) AS n, count_if(complete)::BIGINT AS complete FROM xp GROUP BY language")
def a16_languages(spark, folder):
    return _examples(spark, folder).groupBy("language").agg(F.count("*").alias("n"), F.count_if("complete").alias("complete"))


@query("a8_extraction_report", f"WITH {_SEEN}, {_ENTITIES}, {_RELATIONS}, {_CHECKED}, es AS (SELECT *, {_SCORE} AS score FROM ent), me AS (SELECT name, type, max(score) AS c FROM es WHERE score >= 0.55 GROUP BY ALL), bad AS (SELECT (SELECT count(*) FROM es WHERE score < 0.55) AS e, (SELECT count(*) FROM rr) - (SELECT count(*) FROM ok) AS r) SELECT (SELECT count(*) FROM me) AS entities, (SELECT count(*) FROM mr) AS relations, (SELECT count(*) FROM me WHERE c >= 0.85) AS sure_entities, (SELECT count(*) FROM mr WHERE confidence >= 0.85) AS sure_relations, (SELECT round(avg(c), 3) FROM me) AS entity_confidence, (SELECT round(avg(confidence), 3) FROM mr) AS relation_confidence, e AS invalid_entities, r AS invalid_relations FROM bad")
def a8_extraction_report(spark, folder):
    """Counts, confidences and rejects of what the rules extract."""
    chunks = _chunks(spark, folder)
    raw, checked = x.rule_entities(chunks), x.checked_relations(x.rule_relations(chunks))
    entities = x.merged_entities(raw).agg(F.count("*").alias("entities"), F.count_if(F.col("confidence") >= 0.85).alias("sure_entities"), F.round(F.avg("confidence"), 3).alias("entity_confidence"))
    relations = x.merged_relations(x.rule_relations(chunks)).agg(F.count("*").alias("relations"), F.count_if(F.col("confidence") >= 0.85).alias("sure_relations"), F.round(F.avg("confidence"), 3).alias("relation_confidence"))
    bad_e = x.scored_entities(raw).agg(F.count_if(F.col("score") < 0.55).alias("invalid_entities"))
    bad_r = checked.agg(F.count_if(F.col("reason").isNotNull()).alias("invalid_relations"))
    return entities.crossJoin(relations).crossJoin(bad_e).crossJoin(bad_r)


@query("a9_before_after", KG + """, b AS (SELECT 'before' AS stage, 'node' AS kind, type FROM prepared_entities UNION ALL SELECT 'before', 'edge', type FROM standard_edges UNION ALL SELECT 'after', 'node', type FROM n UNION ALL SELECT 'after', 'edge', type FROM e)
SELECT stage, kind, type AS value, count(*) AS n FROM b WHERE type <> '' GROUP BY ALL UNION ALL SELECT stage, kind, '*', count(*) FROM b GROUP BY stage, kind""")
def a9_before_after(spark, folder):
    """Sizes and types before and after merging."""
    return rp.before_after(table(spark, folder, "prepared_entities"), table(spark, folder, "standard_edges"), *_graph(spark, folder))


@query("a14_labelled", f"{KG}, {QQ}, {_LINKED}, {_EVAL} SELECT CASE WHEN count(*) > 0 THEN 'ready' ELSE 'pending' END AS status, count(*) AS questions, round(avg(precision), 3) AS precision, round(avg(recall), 3) AS recall FROM res WHERE question_id IN (SELECT question_id FROM qq WHERE len(gold) > 0)")
def a14_labelled(spark, folder):
    """The evaluation over questions with gold points only."""
    labelled = _questions(spark, folder).where(F.size("gold") > 0)
    return q.evaluation(labelled, _links(spark, folder)).agg(F.when(F.count("*") > 0, "ready").otherwise("pending").alias("status"), F.count("*").alias("questions"), F.round(F.avg("precision"), 3).alias("precision"), F.round(F.avg("recall"), 3).alias("recall"))


def _mapping(spark, folder):
    """Rule links by id, and gold points by name alone."""
    links = _links(spark, folder).select("question_id", F.col("id").alias("knowledge_id"), F.col("name").alias("knowledge_name"), "role")
    gold = _questions(spark, folder).select("question_id", F.inline("gold")).select("question_id", F.lit("").alias("knowledge_id"), F.col("name").alias("knowledge_name"), "role")
    return links.unionByName(gold)


_MAP = "mp AS (SELECT question_id, id AS kid, name AS kn, role FROM link UNION ALL SELECT question_id, '' AS kid, p.name, p.role FROM (SELECT question_id, unnest(list_distinct(gold)) AS p FROM qq)), nn AS (SELECT id AS low FROM n UNION SELECT lower(" + _STRIP.format("name") + ") FROM n UNION SELECT lower(a) FROM al)"


@query("a18_full_health", f"""{KG}, {QQ}, {_LINKED}, {_MAP} SELECT (SELECT count(*) FROM n) AS nodes, (SELECT count(*) FROM e) AS edges, (SELECT count(*) FROM qq) AS questions, (SELECT count(DISTINCT question_id) FROM mp WHERE question_id <> '') AS question_links,
  (SELECT count(*) FROM t WHERE source NOT IN (SELECT id FROM n) OR target NOT IN (SELECT id FROM n)) AS invalid_edges, (SELECT count(*) FROM e WHERE source = target AND source IN (SELECT id FROM n)) AS self_loops,
  (SELECT count(*) FROM n WHERE id NOT IN (SELECT source FROM e WHERE target IN (SELECT id FROM n) UNION SELECT target FROM e WHERE source IN (SELECT id FROM n))) AS isolated_nodes, (SELECT count(*) FROM mp) AS links,
  (SELECT count(DISTINCT question_id) FROM mp WHERE question_id <> '' AND question_id NOT IN (SELECT question_id FROM qq)) AS invalid_question_ids, (SELECT count(*) FROM mp WHERE kid NOT IN (SELECT id FROM n)) AS invalid_node_ids,
  (SELECT count(*) FROM mp WHERE kid NOT IN (SELECT id FROM n) AND lower(kn) IN (SELECT low FROM nn WHERE low <> '')) AS fallback_name_matches, (SELECT count(*) FROM mp WHERE kid NOT IN (SELECT id FROM n) AND lower(kn) NOT IN (SELECT low FROM nn WHERE low <> '')) AS unresolved_links,
  (SELECT count(DISTINCT question_id) FROM qq WHERE question_id <> '' AND question_id NOT IN (SELECT question_id FROM mp)) AS questions_without_mapping""")
def a18_full_health(spark, folder):
    """All counters of graph, questions and mapping."""
    nodes, edges = _graph(spark, folder)
    return rp.health(nodes, edges, _questions(spark, folder), _mapping(spark, folder), _aliases(spark, folder))


@query("v2_hierarchy", KG + ", p AS (SELECT source AS id, count(*) AS n, min(target) AS up FROM e WHERE type = 'part_of' GROUP BY source), w AS (SELECT id, up AS at, 1 AS k FROM p UNION ALL SELECT w.id, p.up, k + 1 FROM w JOIN p ON p.id = w.at WHERE k < 3000), SELECT_ AS (SELECT id FROM w GROUP BY id HAVING max(k) >= 3000) SELECT (SELECT count(*) FROM e WHERE type = 'part_of') AS hierarchy_edges, (SELECT count(*) FROM p WHERE n <> 1) AS invalid_parents, (SELECT count(*) FROM SELECT_) AS in_cycles")
def v2_hierarchy(spark, folder):
    """Children without exactly one parent, and loops, in the part_of hierarchy."""
    return rp.hierarchy_check(_graph(spark, folder)[1])


@query("v5_audit")
def v5_audit(spark, folder):
    """The release checks and what violates each; single checks have oracles of their own, the rest a fixture."""
    nodes, edges = _graph(spark, folder)
    raw = table(spark, folder, "standard_nodes").dropDuplicates(["row_id"]).select(g.node_id(F.col("id")).alias("id"), "type", "name")
    raw_edges = table(spark, folder, "standard_edges").dropDuplicates(["row_id"]).select(g.node_id(F.col("source")).alias("source"), "type", g.node_id(F.col("target")).alias("target"))
    return rp.release_audit(raw, edges, raw_edges, _questions(spark, folder), _mapping(spark, folder), _aliases(spark, folder), _examples(spark, folder))


@query("v6_formats", KG + "SELECT unnest(['json', 'rdf', 'script']) AS format, (SELECT count(*) FROM n) AS nodes, (SELECT count(*) FROM e) AS edges")
def v6_formats(spark, folder):
    """The size of the graph in each form it is exported in."""
    nodes, edges = _graph(spark, folder)
    statements = sinks.node_statements(nodes, _aliases(spark, folder)).select("statement").unionByName(sinks.edge_statements(edges).select("statement"))
    return rp.format_counts(nodes, edges, v.triples(nodes, edges), statements)


@query("v7_incomplete", f"WITH {_EXPORT} SELECT row_id, title = '' AS no_title, code = '' AS no_code FROM xp WHERE NOT complete")
def v7_incomplete(spark, folder):
    """Examples that must not be exported."""
    return _examples(spark, folder).where("NOT complete").select("row_id", (F.col("title") == "").alias("no_title"), (F.col("code") == "").alias("no_code"))


# ------------------------------------------------- searches and demonstrations


@query("f12_all", f"{KG}, {QQ}, hit AS (SELECT 0 AS rank, ord, 'knowledge' AS kind, id, type FROM n WHERE contains(lower(concat_ws(' ', id, CASE WHEN {_STRIP.format('name')} <> '' THEN {_STRIP.format('name')} ELSE id END, coalesce(type, ''), {_STRIP.format('description')})), 'vtable') UNION ALL SELECT 1, 0, 'question', question_id, type FROM qq WHERE contains(lower(concat_ws(' ', question_id, stem, analysis, array_to_string(list_filter(abilities, lambda a, i: list_position(abilities, a) = i), ' '))), 'vtable')) SELECT kind, id, type FROM hit ORDER BY rank, ord, id LIMIT 12")
def f12_all(spark, folder):
    """A search over nodes and then questions until twelve are found."""
    return rp.search(_graph(spark, folder)[0], _questions(spark, folder), "vtable")


@query("q1_any", KG + "SELECT t.id, source, type, target FROM t WHERE source_type IS NOT NULL AND target_type IS NOT NULL ORDER BY t.ord, t.id LIMIT 80")
def q1_any(spark, folder):
    """The first eighty edges between known nodes."""
    nodes, edges = _graph(spark, folder)
    return g.with_endpoints(edges, nodes).where("source_type IS NOT NULL AND target_type IS NOT NULL").orderBy("ord", "id").limit(80).select("id", "source", "type", "target")


@query("q6_details", KG + "SELECT id, type, description, confidence FROM n WHERE name IN (SELECT name FROM n JOIN hot USING (id))")
def q6_details(spark, folder):
    """What is known of the nodes named as the best-linked one."""
    nodes, edges = _graph(spark, folder)
    hot = g.degrees(edges).orderBy(F.desc("degree"), "id").limit(1).join(nodes.select("id", "name"), "id").select("name")
    return nodes.join(F.broadcast(hot), "name", "left_semi").select("id", "type", "description", "confidence")


_QL = f"{KG}, {QQ}, {_LINKED} "


@query("q11_question_network", _QL + "SELECT question_id, id, name, role FROM link ORDER BY question_id, place LIMIT 100")
def q11_question_network(spark, folder):
    return _links(spark, folder).orderBy("question_id", "place").limit(100).select("question_id", "id", "name", "role")


@query("q12_by_knowledge", _QL + ", top AS (SELECT name FROM link GROUP BY name ORDER BY count(*) DESC, name LIMIT 1) SELECT question_id, role, confidence FROM link WHERE name IN (SELECT name FROM top)")
def q12_by_knowledge(spark, folder):
    """The questions of the most asked knowledge."""
    links = _links(spark, folder)
    top = links.groupBy("name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name").limit(1).select("name")
    return links.join(F.broadcast(top), "name", "left_semi").select("question_id", "role", "confidence")


@query("q13_of_question", _QL + ", f AS (SELECT min(question_id) AS question_id FROM link) SELECT 'ASSESSES' AS relation, name AS value FROM link JOIN f USING (question_id) UNION ALL SELECT 'HAS_TYPE', type FROM qq JOIN f USING (question_id) UNION ALL SELECT 'HAS_DIFFICULTY', difficulty::VARCHAR FROM qq JOIN f USING (question_id) UNION ALL SELECT 'REQUIRES_ABILITY', a FROM (SELECT unnest(list_distinct(abilities)) AS a FROM qq JOIN f USING (question_id))")
def q13_of_question(spark, folder):
    """All that one question is linked to."""
    links = _links(spark, folder)
    first = F.broadcast(links.agg(F.min("question_id").alias("question_id")))
    own = links.select("question_id", F.lit("ASSESSES").alias("relation"), F.col("name").alias("value"))
    return own.unionByName(sinks.question_edges(_questions(spark, folder))).join(first, "question_id", "left_semi").select("relation", "value")


@query("q14_code_reading", _QL + "SELECT link.question_id, name FROM link JOIN qq USING (question_id) WHERE type = 'code_reading'")
def q14_code_reading(spark, folder):
    """Code-reading questions and what they assess."""
    rows = _questions(spark, folder).where("type = 'code_reading'").select("question_id")
    return _links(spark, folder).join(rows, "question_id", "left_semi").select("question_id", "name")


@query("q15_medium", f"WITH {QQ} SELECT question_id, {_LABEL} AS kind FROM qq WHERE {_LEVEL} = '中等'")
def q15_medium(spark, folder):
    return _questions(spark, folder).where("difficulty_label = '中等'").select("question_id", F.col("type_label").alias("kind"))


@query("q16_per_knowledge", _QL + "SELECT name AS knowledge, count(*) AS question_count FROM link GROUP BY name")
def q16_per_knowledge(spark, folder):
    return _links(spark, folder).groupBy(F.col("name").alias("knowledge")).agg(F.count("*").alias("question_count"))


@query("q17_per_type", f"WITH {QQ} SELECT {_LABEL} AS type, count(*) AS question_count FROM qq GROUP BY 1")
def q17_per_type(spark, folder):
    return _questions(spark, folder).groupBy(F.col("type_label").alias("type")).agg(F.count("*").alias("question_count"))


@query("q18_primary", _QL + "SELECT question_id, name, confidence FROM link WHERE role = 'primary'")
def q18_primary(spark, folder):
    return _links(spark, folder).where("role = 'primary'").select("question_id", "name", "confidence")


@query("j9_questions", _QL + f", nm AS (SELECT id, id AS low FROM n UNION SELECT id, lower({_STRIP.format('name')}) FROM n UNION SELECT id, lower(a) FROM al), tn AS (SELECT nm.* FROM nm JOIN hot USING (id) WHERE low <> '') SELECT DISTINCT question_id FROM (SELECT question_id, lower(id) AS low FROM link UNION ALL SELECT question_id, lower(name) FROM link UNION ALL SELECT question_id, lower(p.name) FROM (SELECT question_id, unnest(gold) AS p FROM qq)) z JOIN tn USING (low)")
def j9_questions(spark, folder):
    """Questions of the best-linked node: by link id, link name or gold name, against its id, name and aliases."""
    nodes, edges = _graph(spark, folder)
    hot = F.broadcast(g.degrees(edges).orderBy(F.desc("degree"), "id").limit(1).select("id"))
    return q.questions_of(hot, nodes, _aliases(spark, folder), _questions(spark, folder), _links(spark, folder))


@query("f13_filtered", f"WITH {QQ} SELECT question_id FROM qq WHERE contains(lower(stem || ' ' || code || ' ' || answer || ' ' || analysis || ' ' || array_to_string(abilities, ' ')), 'class') ORDER BY question_id LIMIT 200")
def f13_filtered(spark, folder):
    """A question list at its largest, 200."""
    return q.listed(_questions(spark, folder), "class", 999).select("question_id")


@query("f14_lookups", f"{KG}, {QQ} SELECT 'node' AS kind, n.id, name AS shown FROM n JOIN hot USING (id) UNION ALL SELECT 'question', question_id, stem FROM qq WHERE question_id = (SELECT min(question_id) FROM qq)")
def f14_lookups(spark, folder):
    """One node and one question by id; the filter reaches the scan's aggregation keys."""
    nodes, edges = _graph(spark, folder)
    hot = F.broadcast(g.degrees(edges).orderBy(F.desc("degree"), "id").limit(1).select("id"))
    rows = _questions(spark, folder)
    least = F.broadcast(rows.agg(F.min("question_id").alias("question_id")))
    return nodes.join(hot, "id").select(F.lit("node").alias("kind"), "id", F.col("name").alias("shown")).unionByName(rows.join(least, "question_id").select(F.lit("question").alias("kind"), F.col("question_id").alias("id"), F.col("stem").alias("shown")))


@query("w9_duplicates", "SELECT question_id, count(*) - 1 AS dropped FROM questions GROUP BY question_id HAVING count(*) > 1")
def w9_duplicates(spark, folder):
    """Ids that come more than once; all but the first row are left out."""
    return table(spark, folder, "questions").groupBy("question_id").agg((F.count("*") - 1).alias("dropped")).where("dropped > 0")


@query("w12_sorted_types", KG + "SELECT type, name, id, row_number() OVER (ORDER BY type NULLS FIRST, name NULLS FIRST, id) AS place FROM n WHERE type = 'Skill'")
def w12_sorted_types(spark, folder):
    """Nodes in the order they are written out, numbered; here those of one type."""
    from pyspark.sql.window import Window

    rows = _graph(spark, folder)[0].where("type = 'Skill'").select("type", "name", "id")
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("type").orderBy("name", "id")).cast("bigint"))
