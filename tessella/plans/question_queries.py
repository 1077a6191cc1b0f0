"""Question, resolution and export queries, with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella import sinks
from tessella.operators import graph as g
from tessella.operators import questions as q
from tessella.operators import resolution as r
from tessella.plans.graph_queries import KG
from tessella.runtime import table
from tessella.vocabulary import DIFFICULTIES, NODE_TYPES, QUESTION_TYPES, TYPE_ALIASES

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


def _questions(spark, folder):
    return q.normalized(table(spark, folder, "questions"))


_T = r"coalesce(regexp_replace({0}, '^[\s\x{{3000}}]+|[\s\x{{3000}}]+$', '', 'g'), '')"


def _t(c: str) -> str:
    return _T.format(c)


QQ = f"""qq AS (SELECT {_t("question_id")} AS question_id, {_t("type")} AS type, CASE WHEN {_t("language")} = '' THEN 'Java' ELSE {_t("language")} END AS language, {_t("stem")} AS stem, coalesce(code, '') AS code, {_t("answer")} AS answer, {_t("analysis")} AS analysis,
  greatest(1, least(5, coalesce(difficulty, 2))) AS difficulty, coalesce(difficulty, 2) NOT BETWEEN 1 AND 5 AS bad_level,
  list_filter(list_transform(coalesce(abilities, []), lambda a: {_t("a")}), lambda a: a <> '') AS abilities, list_filter(list_transform(coalesce(options, []), lambda a: {_t("a")}), lambda a: a <> '') AS options,
  list_filter(list_transform(coalesce(gold_knowledge_points, []), lambda p: {{'name': {_t("p.name")}, 'role': CASE WHEN {_t("p.role")} = 'primary' THEN 'primary' ELSE 'secondary' END}}), lambda p: p.name <> '') AS gold
  FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY ingested_at NULLS FIRST, stem NULLS FIRST) AS k FROM questions) WHERE k = 1)"""
_LABEL = "CASE type " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in QUESTION_TYPES.items()) + " ELSE type END"
_LEVEL = "CASE difficulty " + " ".join(f"WHEN {a} THEN '{b}'" for a, b in DIFFICULTIES.items()) + " END"


@query("t22_questions", f"WITH {QQ} SELECT question_id, type, {_LABEL} AS type_label, language, stem, difficulty, {_LEVEL} AS difficulty_label FROM qq")
def t22_questions(spark, folder):
    return _questions(spark, folder).select("question_id", "type", "type_label", "language", "stem", "difficulty", "difficulty_label")


@query("t22_errors", f"WITH {QQ} SELECT question_id, e AS error FROM (SELECT question_id, unnest([CASE WHEN type NOT IN ({', '.join(repr(x) for x in QUESTION_TYPES)}) THEN 'type' END, CASE WHEN bad_level THEN 'difficulty' END, CASE WHEN stem = '' THEN 'stem' END, CASE WHEN len(gold) = 0 THEN 'gold' END]) AS e FROM qq) WHERE e IS NOT NULL")
def t22_errors(spark, folder):
    return _questions(spark, folder).select("question_id", F.explode("errors").alias("error"))


@query("t23_gold", f"WITH {QQ} SELECT DISTINCT question_id, p.name, p.role FROM (SELECT question_id, unnest(gold) AS p FROM qq)")
def t23_gold(spark, folder):
    return _questions(spark, folder).select("question_id", F.explode("gold").alias("p")).select("question_id", "p.name", "p.role")


@query("t24_text", f"WITH {QQ} SELECT question_id, md5(concat_ws(chr(10), nullif(stem, ''), nullif(code, ''), nullif(answer, ''), nullif(analysis, ''), nullif(array_to_string(list_filter(options, lambda o, i: list_position(options, o) = i), ' '), ''))) AS digest FROM qq")
def t24_text(spark, folder):
    rows = _questions(spark, folder)
    return rows.select("question_id", F.md5(q.search_text(rows).cast("binary")).alias("digest"))


@query("a10_counts", f"WITH {QQ} SELECT 'type' AS kind, {_LABEL} AS value, count(*) AS n FROM qq GROUP BY ALL UNION ALL SELECT 'difficulty', {_LEVEL}, count(*) FROM qq GROUP BY ALL UNION ALL SELECT 'ability', a, count(*) FROM (SELECT DISTINCT question_id, unnest(abilities) AS a FROM qq) GROUP BY a UNION ALL SELECT 'gold', p.name, count(*) FROM (SELECT DISTINCT question_id, unnest(gold) AS p FROM qq) GROUP BY p.name")
def a10_counts(spark, folder):
    rows = _questions(spark, folder)
    one = lambda kind, value: F.array(F.struct(F.lit(kind).alias("kind"), value.alias("value")))
    many = lambda kind, values: F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))
    each = F.concat(one("type", F.col("type_label")), one("difficulty", F.col("difficulty_label")), many("ability", F.col("abilities")), many("gold", F.transform("gold", lambda p: p["name"])))
    return rows.select(F.inline(each)).groupBy("kind", "value").agg(F.count("*").alias("n"))


_KEYWORDS = ", ".join(f"('{n}', '{k}')" for k, ns in q.KEYWORDS.items() for n in ns)
_LINKED = f"""known AS (SELECT name, arg_max(id, ord) AS id FROM n WHERE type IN ('KnowledgePoint', 'KnowledgeUnit', 'SyntaxRule', 'ProgrammingLanguage') AND trim(coalesce(name, '')) <> '' GROUP BY name),
al AS (SELECT DISTINCT nr.nid AS id, trim(a) AS a FROM (SELECT nid, unnest(aliases) AS a FROM nr) nr WHERE trim(coalesce(a, '')) <> ''),
kw AS (SELECT * FROM (VALUES {_KEYWORDS}) kw(name, p)),
ph AS (SELECT name, id, lower(trim(name)) AS p, 3.0::DOUBLE AS pt, 0 AS rk, '名称：' || name AS why FROM known UNION ALL SELECT k.name, k.id, lower(a), 3.0, 0, '名称：' || a FROM known k JOIN al USING (id) UNION ALL SELECT k.name, k.id, lower(kw.p), 2.0, 1, '特征：' || kw.p FROM known k JOIN kw ON kw.name = k.name),
qt AS (SELECT question_id, lower(concat_ws(chr(10), nullif(stem, ''), nullif(code, ''), nullif(answer, ''), nullif(analysis, ''), nullif(array_to_string(options, ' '), ''))) AS t FROM qq),
direct AS (SELECT question_id, name, id, sum(pt) AS score, array_to_string(list_transform(list_sort(list_distinct(list({{'r': rk, 'w': why}})))[1:5], lambda x: x.w), '|') AS evidence FROM qt JOIN ph ON contains(t, p) GROUP BY question_id, name, id),
beside AS (SELECT d.question_id, k.name, k.id, 0.8::DOUBLE AS score, '邻居：' || min(d.name) AS evidence FROM direct d JOIN adj ON adj.id = d.id JOIN known k ON k.id = adj.neighbour WHERE NOT EXISTS (SELECT 1 FROM direct x WHERE x.question_id = d.question_id AND x.name = k.name) GROUP BY d.question_id, k.name, k.id),
cand AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, name) AS place FROM (SELECT * FROM direct UNION ALL SELECT * FROM beside)),
link AS (SELECT question_id, name, id, CASE WHEN place <= 2 AND score >= 3 THEN 'primary' ELSE 'secondary' END AS role, round_even(least(0.95, 0.45 + score / 8), 3) AS confidence, place FROM cand WHERE place <= 5 AND (score >= 3 OR place = 1))
"""


def _candidates(spark, folder):
    nodes, edges = _graph(spark, folder)
    return q.candidates(_questions(spark, folder), nodes, g.node_aliases(table(spark, folder, "standard_nodes")), edges)


def _links(spark, folder):
    return q.rule_links(_candidates(spark, folder))


@query("j6_candidates", f"{KG}, {QQ}, {_LINKED} SELECT question_id, name, id, score, evidence, place FROM cand WHERE place <= 12")
def j6_candidates(spark, folder):
    return _candidates(spark, folder).select("question_id", "name", "id", "score", F.array_join("evidence", "|").alias("evidence"), F.col("place").cast("bigint").alias("place"))


@query("w7_links", f"{KG}, {QQ}, {_LINKED} SELECT * FROM link")
def w7_links(spark, folder):
    return _links(spark, folder).drop("evidence").withColumn("place", F.col("place").cast("bigint"))


@query("a11_mapping_report", f"{KG}, {QQ}, {_LINKED} SELECT (SELECT count(*) FROM qq) AS questions, (SELECT count(*) FROM link) AS links, (SELECT count(*) FROM link WHERE role = 'primary') AS primary_links, (SELECT count(*) FROM qq WHERE question_id NOT IN (SELECT question_id FROM link)) AS unmapped")
def a11_mapping_report(spark, folder):
    links = _links(spark, folder)
    questions = _questions(spark, folder).select("question_id")
    none = questions.join(links.select("question_id"), "question_id", "left_anti").agg(F.count("*").alias("unmapped"))
    return questions.agg(F.count("*").alias("questions")).crossJoin(links.agg(F.count("*").alias("links"), F.count_if(F.col("role") == "primary").alias("primary_links"))).crossJoin(none)


_PLAIN = "replace(lower({0}), ' ', '')"
_EVAL = f"""gs AS (SELECT DISTINCT question_id, {_PLAIN.format("p.name")} AS name, p.role AS role FROM (SELECT question_id, unnest(gold) AS p FROM qq)),
ls AS (SELECT question_id, {_PLAIN.format("trim(name)")} AS name, role, place FROM link),
ev AS (SELECT q.question_id, (SELECT count(DISTINCT name) FROM gs WHERE gs.question_id = q.question_id) AS ng, (SELECT count(DISTINCT name) FROM ls WHERE ls.question_id = q.question_id) AS nl,
  (SELECT count(DISTINCT ls.name) FROM ls JOIN gs ON gs.name = ls.name AND gs.question_id = ls.question_id WHERE ls.question_id = q.question_id) AS tp,
  EXISTS (SELECT 1 FROM ls JOIN gs ON gs.name = ls.name AND gs.question_id = ls.question_id WHERE ls.question_id = q.question_id AND ls.role = 'primary' AND gs.role = 'primary') AS primary_hit,
  EXISTS (SELECT 1 FROM ls JOIN gs ON gs.name = ls.name AND gs.question_id = ls.question_id WHERE ls.question_id = q.question_id AND ls.place = 1) AS top_1_hit,
  EXISTS (SELECT 1 FROM ls JOIN gs ON gs.name = ls.name AND gs.question_id = ls.question_id WHERE ls.question_id = q.question_id AND ls.place <= 3) AS top_3_hit FROM qq q),
pr AS (SELECT *, CASE WHEN nl = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / nl END AS p, CASE WHEN ng = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / ng END AS r FROM ev),
res AS (SELECT question_id, round_even(p, 4) AS precision, round_even(r, 4) AS recall, round_even(CASE WHEN p + r = 0 THEN 0.0::DOUBLE ELSE 2 * p * r / (p + r) END, 4) AS f1, primary_hit, top_1_hit, top_3_hit, nl = 0 AS unmapped FROM pr)
"""


@query("a12_evaluation", f"{KG}, {QQ}, {_LINKED}, {_EVAL} SELECT * FROM res")
def a12_evaluation(spark, folder):
    return q.evaluation(_questions(spark, folder), _links(spark, folder))


@query("a13_macro", f"{KG}, {QQ}, {_LINKED}, {_EVAL} SELECT count(*) AS questions, round(avg(precision), 3) AS precision, round(avg(recall), 3) AS recall, count_if(primary_hit)::BIGINT AS primary_hits, count_if(top_1_hit)::BIGINT AS top_1_hits, count_if(top_3_hit)::BIGINT AS top_3_hits, count_if(unmapped)::BIGINT AS unmapped FROM res")
def a13_macro(spark, folder):
    rows = q.evaluation(_questions(spark, folder), _links(spark, folder))
    return rows.agg(F.count("*").alias("questions"), F.round(F.avg("precision"), 3).alias("precision"), F.round(F.avg("recall"), 3).alias("recall"), F.count_if("primary_hit").alias("primary_hits"), F.count_if("top_1_hit").alias("top_1_hits"), F.count_if("top_3_hit").alias("top_3_hits"), F.count_if("unmapped").alias("unmapped"))


@query("q15_by_difficulty", f"WITH {QQ} SELECT {_LEVEL} AS level, {_LABEL} AS kind, count(*) AS n FROM qq GROUP BY ALL")
def q15_by_difficulty(spark, folder):
    return _questions(spark, folder).groupBy(F.col("difficulty_label").alias("level"), F.col("type_label").alias("kind")).agg(F.count("*").alias("n"))


@query("f13_list", f"WITH {QQ} SELECT question_id FROM qq WHERE contains(lower(stem || ' ' || code || ' ' || answer || ' ' || analysis), 'class') ORDER BY question_id LIMIT 50")
def f13_list(spark, folder):
    """A question list: the first fifty that mention a word."""
    rows = _questions(spark, folder)
    return rows.where(F.contains(F.lower(F.concat_ws(" ", "stem", "code", "answer", "analysis")), F.lit("class"))).orderBy("question_id").limit(50).select("question_id")


@query("j9_by_knowledge", f"{KG}, {QQ}, {_LINKED} SELECT k.id, k.name, count(DISTINCT question_id) AS questions FROM known k JOIN (SELECT name, question_id FROM link UNION SELECT p.name, question_id FROM (SELECT question_id, unnest(gold) AS p FROM qq)) x ON lower(x.name) = lower(k.name) GROUP BY k.id, k.name")
def j9_by_knowledge(spark, folder):
    nodes, _ = _graph(spark, folder)
    gold = _questions(spark, folder).select("question_id", F.explode("gold").alias("p")).select(F.lower("p.name").alias("low"), "question_id")
    linked = _links(spark, folder).select(F.lower("name").alias("low"), "question_id")
    known = q.linkable(nodes).select("id", "name", F.lower("name").alias("low"))
    return known.join(gold.unionByName(linked).distinct(), "low").groupBy("id", "name").agg(F.countDistinct("question_id").alias("questions"))


# -------------------------------------------------------------- resolution

_TYPE = "CASE WHEN {0} IN (" + ", ".join(repr(x) for x in NODE_TYPES) + ") THEN {0} " + " ".join(f"WHEN lower({{0}}) = '{a}' THEN '{b}'" for a, b in TYPE_ALIASES.items()) + " ELSE {0} END"
PREP = f"""pe AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY raw_id ORDER BY ingested_at NULLS FIRST, original_name NULLS FIRST) AS k FROM prepared_entities) WHERE k = 1),
pp AS (SELECT raw_id, {_TYPE.format(_t("original_type"))} AS type, CASE WHEN confidence IS NULL OR isnan(confidence) THEN 0.0 ELSE greatest(0.0, least(confidence, 1.0)) END AS confidence, {_t("original_name")} AS nm FROM pe)"""


@query("m4_prepared", f"WITH {PREP} SELECT raw_id, type, confidence, CASE WHEN nm = '' THEN 'name' WHEN type NOT IN ({', '.join(repr(x) for x in NODE_TYPES)}) THEN 'type' WHEN confidence < 0.55 THEN 'confidence' END AS reason FROM pp")
def m4_prepared(spark, folder):
    return r.prepared(table(spark, folder, "prepared_entities"))


_PRINT = "regexp_replace(lower(coalesce(name, '')), '[\\s_\\-·.。,:：;；()（）\\[\\]【】{}<>《》/\\\\]+', '', 'g')"
_NAMES = f"fp AS (SELECT DISTINCT raw_id, type, {_PRINT} AS p FROM prepared_entities WHERE raw_id IS NOT NULL), ml AS (SELECT DISTINCT a, raw_id AS b FROM (SELECT raw_id, min(raw_id) OVER (PARTITION BY type, p) AS a FROM fp WHERE p <> '' AND type IS NOT NULL) WHERE a <> raw_id)"


@query("g12_name_links", f"WITH {_NAMES} SELECT a, b FROM ml")
def g12_name_links(spark, folder):
    return r.name_links(table(spark, folder, "prepared_entities"))


@query("g11_components", f"WITH RECURSIVE {_NAMES}, ed AS (SELECT a, b FROM ml UNION SELECT b, a FROM ml), re AS (SELECT DISTINCT a AS x, a AS y FROM ed UNION SELECT re.x, ed.b FROM re JOIN ed ON re.y = ed.a) SELECT x AS vertex, min(y) AS root FROM re GROUP BY x")
def g11_components(spark, folder):
    return r.union_groups(r.name_links(table(spark, folder, "prepared_entities")))


@query("a7_merged_nodes", f"WITH {PREP}, {_NAMES}, rt AS (SELECT b AS raw_id, min(a) AS root FROM ml GROUP BY b), x AS (SELECT coalesce(rt.root, pe.raw_id) AS root, pe.name, pe.type, CASE WHEN pe.confidence IS NULL OR isnan(pe.confidence) THEN 0.0 ELSE greatest(0.0, least(pe.confidence, 1.0)) END AS c FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY raw_id ORDER BY ingested_at NULLS FIRST, name NULLS FIRST) AS kk FROM prepared_entities) WHERE kk = 1) pe LEFT JOIN rt USING (raw_id)) SELECT root, first(name ORDER BY c DESC, length(name), name) FILTER (WHERE name IS NOT NULL) AS name, min(type) AS type, count(*) AS members, max(c) AS confidence FROM x GROUP BY root")
def a7_merged_nodes(spark, folder):
    rows = table(spark, folder, "prepared_entities")
    return r.merged_nodes(rows, r.union_groups(r.name_links(rows))).select("root", "name", "type", "members", "confidence")


def _merge_links(spark, folder):
    return r.merge_links(*(table(spark, folder, name) for name in ("prepared_entities", "entity_matches", "standard_nodes", "standard_edges")))


_LINKS = (
    KG
    + f""", {_NAMES}, kn AS (SELECT DISTINCT raw_id FROM prepared_entities WHERE raw_id IS NOT NULL),
mb AS (SELECT DISTINCT lower(trim(id)) AS id, raw_id FROM (SELECT id, unnest(original_entity_ids) AS raw_id FROM standard_nodes) JOIN kn USING (raw_id)),
eq AS (SELECT source, target FROM t WHERE type = 'equivalent_to' AND confidence >= 0.9 AND source_type = target_type AND source <> target),
em AS (SELECT source, target, 0 AS side, raw_id FROM eq JOIN mb ON mb.id = source UNION ALL SELECT source, target, 1, raw_id FROM eq JOIN mb ON mb.id = target),
eh AS (SELECT source, target, min(raw_id) AS a FROM em GROUP BY source, target HAVING min(side) < max(side)),
lk AS (SELECT a, b FROM ml UNION SELECT a, raw_id FROM em JOIN eh USING (source, target) WHERE raw_id <> a
  UNION SELECT least(left_id, right_id), greatest(left_id, right_id) FROM entity_matches WHERE verdict = 'same' AND left_id <> right_id AND left_id IN (SELECT raw_id FROM kn) AND right_id IN (SELECT raw_id FROM kn))
"""
)
_GROUPS = _LINKS + ", ed AS (SELECT a, b FROM lk UNION SELECT b, a FROM lk), re AS (SELECT DISTINCT a AS x, a AS y FROM ed UNION SELECT re.x, ed.b FROM re JOIN ed ON re.y = ed.a), gr AS (SELECT x AS vertex, min(y) AS root FROM re GROUP BY x)\n"


@query("g12_merge_links", _LINKS + "SELECT a, b FROM lk")
def g12_merge_links(spark, folder):
    """All merge links: g12_name_links, sure equivalence and accepted pairs."""
    return _merge_links(spark, folder)


@query("g11_merge_groups", _GROUPS + "SELECT vertex, root FROM gr")
def g11_merge_groups(spark, folder):
    """The groups of g12_merge_links, as g11_components are those of the names alone."""
    return r.union_groups(_merge_links(spark, folder))


@query(
    "a7_resolved_nodes",
    _GROUPS
    + """, x AS (SELECT coalesce(gr.root, pe.raw_id) AS root, pe.name, pe.type, pe.description, CASE WHEN pe.confidence IS NULL OR isnan(pe.confidence) THEN 0.0 ELSE greatest(0.0, least(pe.confidence, 1.0)) END AS c
  FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY raw_id ORDER BY ingested_at NULLS FIRST, name NULLS FIRST) AS kk FROM prepared_entities) WHERE kk = 1) pe LEFT JOIN gr ON gr.vertex = pe.raw_id),
tc AS (SELECT root, first(type ORDER BY n DESC, type) AS type FROM (SELECT root, type, count(*) AS n FROM x WHERE type IS NOT NULL GROUP BY root, type) GROUP BY root)
SELECT x.root, first(name ORDER BY c DESC, length(name), name) FILTER (WHERE name IS NOT NULL) AS name, any_value(tc.type) AS type, """
    + f"first(description ORDER BY length(description) DESC, description) FILTER (WHERE {_t('description')} <> '') AS description, count(*) AS members, max(c) AS confidence FROM x LEFT JOIN tc ON tc.root = x.root GROUP BY x.root",
)
def a7_resolved_nodes(spark, folder):
    """One node of every group of g11_merge_groups and of every record without a link."""
    return r.merged_nodes(table(spark, folder, "prepared_entities"), r.union_groups(_merge_links(spark, folder)))


def _rooted(spark, folder):
    return r.rooted(table(spark, folder, "prepared_entities"), r.union_groups(_merge_links(spark, folder)))


_ROOTED = _GROUPS + ", rd AS (SELECT coalesce(gr.root, pe.raw_id) AS root, pe.* FROM prepared_entities pe LEFT JOIN gr ON gr.vertex = pe.raw_id WHERE pe.raw_id IS NOT NULL)\n"


@query("a7_node_members", _ROOTED + "SELECT DISTINCT root, raw_id FROM rd")
def a7_node_members(spark, folder):
    """The original ids of every node of a7_resolved_nodes."""
    return _rooted(spark, folder).select("root", "raw_id").distinct()


@query("a7_node_chunks", _ROOTED + f"SELECT DISTINCT root, chunk_id FROM (SELECT root, {_t('c')} AS chunk_id FROM (SELECT root, unnest(source_chunk_ids) AS c FROM rd)) WHERE chunk_id <> ''")
def a7_node_chunks(spark, folder):
    return g.union_rows(_rooted(spark, folder), {"root": F.col("root")}, "source_chunk_ids", "chunk_id")


@query("a7_node_sources", _ROOTED + "SELECT DISTINCT root, s.chunk_id, s.source_file, s.page FROM (SELECT root, unnest(sources) AS s FROM rd) WHERE s IS NOT NULL")
def a7_node_sources(spark, folder):
    return g.source_rows(_rooted(spark, folder), {"root": F.col("root")})


@query("a7_node_aliases")
def a7_node_aliases(spark, folder):
    """The other spellings of every node of a7_resolved_nodes."""
    return r.merged_aliases(table(spark, folder, "prepared_entities"), r.union_groups(_merge_links(spark, folder)))


def _unions(name: str, source: str, keys: dict, lists: dict[str, tuple[str, str]]) -> None:
    """Registers a query and its SQL for the sources, and for each list column, of the groups of a table; keys: name to whether it is a node id, lists: name to column and name of the member."""
    columns = lambda: {k: g.node_id(F.col(k)) if is_id else F.col(k) for k, is_id in keys.items()}
    bare = ", ".join(f"lower(trim({k})) AS {k}" if is_id else k for k, is_id in keys.items())
    some = " AND ".join("name IS NOT NULL" if k == "name" else f"{k} <> ''" for k in keys if k != "type")

    def put(query_name, sql, operator):
        def run(spark, folder):
            return operator(table(spark, folder, source)).where(some)

        query(query_name, sql)(run)

    put(f"{name}_sources", f"SELECT DISTINCT {', '.join(keys)}, s.chunk_id, s.source_file, s.page FROM (SELECT {bare}, unnest(sources) AS s FROM {source}) WHERE s IS NOT NULL AND {some}", lambda rows: g.source_rows(rows, columns()))
    for suffix, (column, member) in lists.items():
        sql = f"SELECT DISTINCT * FROM (SELECT {', '.join(keys)}, {_t('m')} AS {member} FROM (SELECT {bare}, unnest({column}) AS m FROM {source})) WHERE {member} <> '' AND {some}"
        put(f"{name}_{suffix}", sql, lambda rows, column=column, member=member: g.union_rows(rows, columns(), column, member))


# What a4_entity_merge counts, and what the merged nodes and edges of the graph come from.
_unions("a4_entity", "entities", {"type": False, "name": False}, {"chunks": ("source_chunk_ids", "chunk_id")})
_unions("s12_node", "standard_nodes", {"id": True}, {"chunks": ("source_chunk_ids", "chunk_id"), "originals": ("original_entity_ids", "raw_id")})
_unions("a5_edge", "standard_edges", {"source": True, "type": False, "target": True}, {"chunks": ("source_chunks", "chunk_id"), "originals": ("original_relation_ids", "relation_id")})



@query("c5_types", f"SELECT DISTINCT original_type, {_TYPE.format(_t('original_type'))} AS type FROM prepared_entities")
def c5_types(spark, folder):
    return table(spark, folder, "prepared_entities").select("original_type").distinct().select("original_type", r.normal_type(F.col("original_type")).alias("type"))


# ----------------------------------------------------------------- exports


@query("k5_flat", f"SELECT row_id, trim(id) AS id, CASE WHEN confidence IS NULL OR isnan(confidence) THEN 0.0 ELSE greatest(0.0, least(confidence, 1.0)) END AS confidence, len(list_distinct(list_filter(list_transform(coalesce(sources, []), lambda s: {_t('s.source_file')}), lambda x: x <> '')))::BIGINT AS files, len(list_distinct(list_filter(list_transform(coalesce(sources, []), lambda s: s.page::VARCHAR), lambda x: x IS NOT NULL)))::BIGINT AS pages FROM standard_nodes")
def k5_flat(spark, folder):
    rows = sinks.flat_nodes(table(spark, folder, "standard_nodes"))
    return rows.select("row_id", "id", "confidence", F.size("source_files").cast("bigint").alias("files"), F.size("source_pages").cast("bigint").alias("pages"))


@query("k4_edge_statements", KG + """SELECT id, 'MATCH (source:KnowledgeNode {id: "' || source || '"})' || chr(10) || 'MATCH (target:KnowledgeNode {id: "' || target || '"})' || chr(10) || 'MERGE (source)-[r:' || upper(regexp_replace(type, '[^A-Za-z0-9_]', '_', 'g')) || ' {id: "' || id || '"}]->(target);' AS statement FROM e""")
def k4_edge_statements(spark, folder):
    return sinks.edge_statements(_graph(spark, folder)[1])


@query(
    "k4_node_statements",
    KG
    + f""", al AS (SELECT id, list_sort(list(DISTINCT a)) AS ls FROM (SELECT lower(trim(id)) AS id, {_t("a")} AS a FROM (SELECT id, unnest(aliases) AS a FROM standard_nodes)) WHERE id <> '' AND a <> '' GROUP BY id)
SELECT n.id, 'MERGE (n:KnowledgeNode:' || regexp_replace({_t("type")}, '[^A-Za-z0-9_]', '_', 'g') || ' {{id: ' || to_json(n.id) || '}})' || chr(10) || 'SET n += {{name: ' || to_json(coalesce(n.name, '')) || ', type: ' || to_json(coalesce(n.type, '')) || ', aliases: [' || coalesce(array_to_string(list_transform(ls, lambda x: to_json(x)), ', '), '') || ']}};' AS statement FROM n LEFT JOIN al USING (id)""",
)
def k4_node_statements(spark, folder):
    """One import statement per node."""
    return sinks.node_statements(_graph(spark, folder)[0], g.node_aliases(table(spark, folder, "standard_nodes")))


@query("k7_question_edges", f"WITH {QQ} SELECT question_id, 'HAS_TYPE' AS relation, type AS value FROM qq UNION ALL SELECT question_id, 'HAS_DIFFICULTY', difficulty::VARCHAR FROM qq UNION ALL SELECT DISTINCT question_id, 'REQUIRES_ABILITY', unnest(abilities) FROM qq")
def k7_question_edges(spark, folder):
    return sinks.question_edges(_questions(spark, folder))


@query("k11_examples", KG + "SELECT id, name FROM n WHERE type = 'CodeExample' AND trim(coalesce(name, '')) <> ''")
def k11_examples(spark, folder):
    return _graph(spark, folder)[0].where("type = 'CodeExample' AND trim(coalesce(name, '')) <> ''").select("id", "name")
