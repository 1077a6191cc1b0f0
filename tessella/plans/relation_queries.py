"""Extraction and endpoint queries, with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.operators import exercises as ex
from tessella.operators import extraction as x
from tessella.operators import resolution as r
from tessella.operators.graph import graph_edges, graph_nodes
from tessella.plans.graph_queries import KG
from tessella.plans.question_queries import PREP
from tessella.plans.text_queries import _LOW, _WS, CHUNKS, RAW, _any, _q, _chunks, _raw
from tessella.runtime import table
from tessella.vocabulary import CONCEPTS, ENTITY_TERMS, EXTRACTED_SCHEMA, FORCED_TYPES, RELATION_SCHEMA, SYNTAX, SYNTAX_CONCEPTS

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


_normal = "coalesce(content, '')"
for _old, _new in ENTITY_TERMS:
    _normal = f"regexp_replace({_normal}, {_q(_old)}, {_q(_new)}, 'gi')"
_ORDERED = lambda words: ", ".join(_q(w) for w in sorted(set(words), key=lambda w: (len(w), w)))
_EXPRESSES = "CASE {0} " + " ".join(f"WHEN {_q(a)} THEN {_q(b)}" for a, b in SYNTAX_CONCEPTS.items()) + " END"
_ID = "[A-Za-z_]\\w*"
_FIND = {
    "class": f"\\bclass\\s+({_ID})",
    "interface": f"\\binterface\\s+({_ID})",
    "method": f"\\b(?:public|private|protected)?\\s*(?:static\\s+)?(?:void|int|String|boolean|double|float|char)\\s+({_ID})\\s*\\(",
    "inherits_from": f"\\bclass\\s+({_ID})\\s+extends\\s+({_ID})",
    "implements_interface": f"\\bclass\\s+({_ID})\\s+implements\\s+({_ID})",
}
_C = "coalesce(content, '')"
_SEEN = f"""ch AS MATERIALIZED (SELECT chunk_id, {_C} AS content, CASE WHEN coalesce(language, '') NOT IN ('通用OOP', '通用编程', '未识别', '') THEN language END AS lang,
  list_filter([{_ORDERED(CONCEPTS)}], lambda w: contains({_normal}, w)) AS concepts,
  list_filter([{_ORDERED(SYNTAX)}], lambda w: regexp_matches({_LOW}, '(^|[^\\p{{L}}\\p{{N}}_\\p{{M}}])' || w || '($|[^\\p{{L}}\\p{{N}}_\\p{{M}}])')) AS syntax,
  CASE WHEN coalesce(material_role = 'code_example', false) OR regexp_matches({_C}, '\\b(class|interface|extends|implements|public|private|protected|void|new)\\b|[{{}};]') THEN 'CodeExample_' || chunk_id END AS ex FROM {CHUNKS}),
co AS (SELECT chunk_id, content, lang, ex, unnest(concepts) AS w FROM ch), sy AS (SELECT chunk_id, content, lang, ex, unnest(syntax) AS w FROM ch),
de AS ({" UNION ALL ".join(f"SELECT chunk_id, content, ex, p.a AS w, p.b AS ev FROM (SELECT chunk_id, content, ex, unnest(list_transform(range(len(a)), lambda i: {{'a': a[i + 1], 'b': b[i + 1]}})) AS p FROM (SELECT *, regexp_extract_all(content, '{_FIND[k]}', 1) AS a, regexp_extract_all(content, '{_FIND[k]}', 0) AS b FROM ch))" for k in ("class", "interface", "method"))}),
li AS ({" UNION ALL ".join(f"SELECT chunk_id, content, p.h, '{k}' AS rel, p.t, p.ev FROM (SELECT chunk_id, content, unnest(list_transform(range(len(a)), lambda i: {{'h': a[i + 1], 't': b[i + 1], 'ev': c[i + 1]}})) AS p FROM (SELECT *, regexp_extract_all(content, '{_FIND[k]}', 1) AS a, regexp_extract_all(content, '{_FIND[k]}', 2) AS b, regexp_extract_all(content, '{_FIND[k]}', 0) AS c FROM ch))" for k in ("inherits_from", "implements_interface"))})"""
_SHORT = f"substr(regexp_replace(regexp_replace(content, '{_WS}+', ' ', 'g'), '^ +| +$', '', 'g'), 1, 120)"
_ENTITIES = f"""ent AS (SELECT chunk_id, content, '面向对象编程' AS name, 'ProgrammingParadigm' AS type, 0.95::DOUBLE AS confidence, '面向对象' AS ev FROM ch
UNION ALL SELECT chunk_id, content, lang, 'ProgrammingLanguage', 0.9, lang FROM ch WHERE lang IS NOT NULL
UNION ALL SELECT chunk_id, content, w, 'OOPConcept', 0.82, w FROM co
UNION ALL SELECT chunk_id, content, w, 'SyntaxRule', 0.86, w FROM sy
UNION ALL SELECT chunk_id, content, {_EXPRESSES.format("w")}, 'OOPConcept', 0.8, {_EXPRESSES.format("w")} FROM sy WHERE {_EXPRESSES.format("w")} IS NOT NULL
UNION ALL SELECT chunk_id, content, ex, 'CodeExample', 0.9, {_SHORT} FROM ch WHERE ex IS NOT NULL
UNION ALL SELECT chunk_id, content, w, 'CodeStructure', 0.86, ev FROM de WHERE ex IS NOT NULL
UNION ALL SELECT chunk_id, content, h, 'CodeStructure', 0.86, ev FROM li UNION ALL SELECT chunk_id, content, t, 'CodeStructure', 0.86, ev FROM li)"""
_RELATIONS = f"""rel AS (SELECT chunk_id, content, w AS head, 'OOPConcept' AS ht, 'belongs_to_paradigm' AS relation, '面向对象编程' AS tail, 'ProgrammingParadigm' AS tt, 0.88::DOUBLE AS confidence, w AS ev FROM co
UNION ALL SELECT chunk_id, content, w, 'OOPConcept', 'implemented_in', lang, 'ProgrammingLanguage', 0.72, lang FROM co WHERE lang IS NOT NULL
UNION ALL SELECT chunk_id, content, w, 'SyntaxRule', 'implemented_in', lang, 'ProgrammingLanguage', 0.8, w FROM sy WHERE lang IS NOT NULL
UNION ALL SELECT chunk_id, content, {_EXPRESSES.format("w")}, 'OOPConcept', 'has_syntax', w, 'SyntaxRule', 0.86, w FROM sy WHERE {_EXPRESSES.format("w")} IS NOT NULL
UNION ALL SELECT chunk_id, content, w, 'SyntaxRule', 'expresses_concept', {_EXPRESSES.format("w")}, 'OOPConcept', 0.86, w FROM sy WHERE {_EXPRESSES.format("w")} IS NOT NULL
UNION ALL SELECT chunk_id, content, ex, 'CodeExample', 'demonstrates', w, 'OOPConcept', 0.82, w FROM co WHERE ex IS NOT NULL
UNION ALL SELECT chunk_id, content, ex, 'CodeExample', 'uses_syntax', w, 'SyntaxRule', 0.84, w FROM sy WHERE ex IS NOT NULL
UNION ALL SELECT chunk_id, content, ex, 'CodeExample', 'contains_structure', w, 'CodeStructure', 0.86, ev FROM de WHERE ex IS NOT NULL
UNION ALL SELECT chunk_id, content, h, 'CodeStructure', rel, t, 'CodeStructure', 0.88, ev FROM li)"""


@query("g14_rule_entities", f"WITH {_SEEN}, {_ENTITIES} SELECT chunk_id, name, type, confidence, ev AS evidence FROM ent")
def g14_rule_entities(spark, folder):
    """Entities that the rules find in the chunks."""
    return x.rule_entities(_chunks(spark, folder)).drop("content")


@query("g14_rule_relations", f"WITH {_SEEN}, {_RELATIONS} SELECT chunk_id, head, ht AS head_type, relation, tail, tt AS tail_type, confidence, ev AS evidence FROM rel")
def g14_rule_relations(spark, folder):
    """Relations that the rules find in the chunks."""
    return x.rule_relations(_chunks(spark, folder)).drop("content")


_STRIPPED = "regexp_replace({0}, '^[\\s\\x{{3000}}]+|[\\s\\x{{3000}}]+$', '', 'g')"
_SCORE = "round_even(greatest(0.0, least(least(confidence, 1.0) + CASE WHEN " + _STRIPPED.format("coalesce(ev, '')") + " = '' THEN -0.08 WHEN contains(content, " + _STRIPPED.format("ev") + ") THEN 0.05 ELSE 0.0 END, 0.98)), 4)"


@query("g15_merged_entities", f"WITH {_SEEN}, {_ENTITIES}, sc AS (SELECT *, {_SCORE} AS score FROM ent) SELECT name, type, max(score) AS confidence, count(DISTINCT chunk_id) AS chunks, 'ent_' || substr(md5(type || ':' || name), 1, 12) AS id FROM sc WHERE score >= 0.55 GROUP BY name, type")
def g15_merged_entities(spark, folder):
    """The rules' entities, scored, filtered and merged."""
    return x.merged_entities(x.rule_entities(_chunks(spark, folder)))


_NAME = "CASE lower({0}) " + " ".join(f"WHEN {_q(a.lower())} THEN {_q(b)}" for a, b in ENTITY_TERMS) + " ELSE {0} END"
_KIND = "CASE {0} " + " ".join(f"WHEN {_q(a)} THEN {_q(b)}" for a, b in FORCED_TYPES.items()) + " ELSE {1} END"
_VALID = "(VALUES " + ", ".join(f"('{k}', '{h}', '{t}')" for k, (hs, ts) in EXTRACTED_SCHEMA.items() for h in hs for t in ts) + ") v(r, h, d)"
_CHECKED = f"""nm AS (SELECT *, {_NAME.format("trim(head)")} AS hn, {_NAME.format("trim(tail)")} AS tn, {_SCORE} AS score FROM rel),
ty AS (SELECT *, {_KIND.format("hn", "ht")} AS h1, {_KIND.format("tn", "tt")} AS t1 FROM nm),
fx AS (SELECT *, relation = 'has_code_structure' AND h1 = 'OOPConcept' AND t1 = 'OOPConcept' OR relation = 'has_syntax' AND h1 = 'SyntaxRule' AND t1 = 'OOPConcept' OR relation = 'belongs_to_paradigm' AND t1 = 'OOPConcept' AND h1 = 'ProgrammingParadigm' OR relation = 'belongs_to_paradigm' AND h1 = 'ProgrammingLanguage' AND t1 = 'ProgrammingParadigm' AS turn,
  CASE WHEN relation = 'part_of' AND h1 = 'OOPConcept' AND t1 = 'ProgrammingParadigm' THEN 'belongs_to_paradigm' WHEN relation = 'part_of' AND h1 = 'OOPConcept' AND t1 = 'ProgrammingLanguage' THEN 'implemented_in' WHEN relation = 'belongs_to_paradigm' AND h1 = 'ProgrammingLanguage' AND t1 = 'ProgrammingParadigm' THEN 'implemented_in'
  WHEN relation IN ('has_code_structure', 'expresses_concept') AND h1 = 'OOPConcept' AND t1 = 'OOPConcept' THEN 'part_of' ELSE relation END AS r1 FROM ty),
rr AS (SELECT chunk_id, CASE WHEN turn THEN tn ELSE hn END AS head, CASE WHEN turn THEN t1 ELSE h1 END AS head_type, r1 AS relation, CASE WHEN turn THEN hn ELSE tn END AS tail, CASE WHEN turn THEN h1 ELSE t1 END AS tail_type, score, ev FROM fx),
ok AS (SELECT rr.* FROM rr JOIN {_VALID} ON v.r = relation AND v.h = head_type AND v.d = tail_type WHERE score >= 0.6),
mr AS (SELECT head, head_type, relation, tail, tail_type, max(score) AS confidence, first(ev ORDER BY length(ev) DESC, ev DESC) AS evidence, count(DISTINCT chunk_id) AS chunks, 'rel_' || substr(md5(head || ':' || relation || ':' || tail), 1, 12) AS id FROM ok GROUP BY ALL)"""


@query("g15_relations", f"WITH {_SEEN}, {_RELATIONS}, {_CHECKED} SELECT * FROM mr")
def g15_relations(spark, folder):
    """The rules' relations: named, typed, put right, scored, checked against the schema and merged."""
    return x.merged_relations(x.rule_relations(_chunks(spark, folder)))


@query("g15_rejected", f"WITH {_SEEN}, {_RELATIONS}, {_CHECKED} SELECT CASE WHEN score < 0.6 THEN 'low_confidence' ELSE 'schema_mismatch' END AS reason, relation, count(*) AS n FROM rr LEFT JOIN {_VALID} ON v.r = relation AND v.h = head_type AND v.d = tail_type WHERE v.r IS NULL OR score < 0.6 GROUP BY ALL")
def g15_rejected(spark, folder):
    """Why extracted relations are left out."""
    return x.checked_relations(x.rule_relations(_chunks(spark, folder))).where("reason IS NOT NULL").groupBy("reason", "relation").agg(F.count("*").alias("n"))


@query("j5_completed", f"WITH {_SEEN}, {_ENTITIES}, {_RELATIONS}, {_CHECKED}, me AS (SELECT DISTINCT name, type FROM (SELECT *, {_SCORE} AS score FROM ent) WHERE score >= 0.55) SELECT name, type, greatest(0.55, max(confidence) - 0.05) AS confidence FROM (SELECT head AS name, head_type AS type, confidence FROM mr UNION ALL SELECT tail, tail_type, confidence FROM mr) z WHERE NOT EXISTS (SELECT 1 FROM me WHERE me.name = z.name AND me.type = z.type) GROUP BY name, type")
def j5_completed(spark, folder):
    """Ends of relations that no extracted entity stands for."""
    chunks = _chunks(spark, folder)
    return x.completed_entities(x.merged_entities(x.rule_entities(chunks)), x.merged_relations(x.rule_relations(chunks)))


# ---------------------------------------------------------------- endpoints


def _as_relations(spark, folder):
    """The graph's edges as relations between named and typed ends."""
    nodes, edges = graph_nodes(table(spark, folder, "standard_nodes")), graph_edges(table(spark, folder, "standard_edges"))
    side = lambda c, n: nodes.select(F.col("id").alias(c), F.col("name").alias(n), F.col("type").alias(f"{n}_type"))
    return edges.join(side("source", "head"), "source").join(side("target", "tail"), "target").select("id", "head", "head_type", F.col("type").alias("relation"), "tail", "tail_type", "confidence")


def _prepared(spark, folder):
    rows = table(spark, folder, "prepared_entities")
    return rows.groupBy("raw_id").agg(F.min_by(F.struct("name", "type", "original_name", "original_type"), F.struct("ingested_at", "original_name")).alias("e")).select(F.col("raw_id").alias("id"), "e.*", F.col("raw_id").alias("ord"))


@query("c4_names")
def c4_names(spark, folder):
    """The one spelling of each original name; SQL has no compatibility forms, so plain Python is the test."""
    return table(spark, folder, "prepared_entities").select("raw_id", "original_name").distinct().select("raw_id", "original_name", r.canonical_name(F.col("original_name")).alias("name"))


@query("c5_relations", "SELECT neo4j_type AS given, CASE WHEN lower(trim(neo4j_type)) = '' THEN '' ELSE lower(trim(neo4j_type)) END AS relation, count(*) AS n FROM standard_edges WHERE neo4j_type IS NOT NULL AND regexp_matches(neo4j_type, '^[ -~]*$') GROUP BY ALL")
def c5_relations(spark, folder):
    """Relations as written in capitals to the vocabulary's names."""
    rows = table(spark, folder, "standard_edges").where(F.col("neo4j_type").isNotNull() & F.rlike("neo4j_type", F.lit("^[ -~]*$")))
    return rows.groupBy(F.col("neo4j_type").alias("given"), r.canonical_relation(F.col("neo4j_type"), tuple(RELATION_SCHEMA)).alias("relation")).agg(F.count("*").alias("n"))


@query("j2_resolved_ends")
def j2_resolved_ends(spark, folder):
    """Each edge's ends as names and types, resolved to prepared entities, with fallback; tested against a plain lookup."""
    return r.resolve_endpoints(_as_relations(spark, folder), _prepared(spark, folder)).select("id", "head_id", "tail_id")


@query("j4_inferred")
def j4_inferred(spark, folder):
    """Entities inferred from ends of edges; tested against plain Python."""
    return r.inferred_entities(_as_relations(spark, folder), _prepared(spark, folder))


# ---------------------------------------------------------------- exercises

_LINES = f"list_filter(list_transform(string_split_regex(coalesce({{0}}, ''), '\\r\\n|\\n|\\r'), lambda x: regexp_replace(x, '^{_WS}+|{_WS}+$', '', 'g')), lambda x: x <> '')"
_START = "(?i)^(?:\\d+[.、．]|Given\\b|Define\\b|Please\\b|Write\\b|Implement\\b|In the following\\b|According to\\b|A stack\\b|Important aspects\\b|选择|打开文件|假设|对下面|阅读下面|用C\\+\\+|已知类|下表中)"
_STARTS = f"(regexp_matches({{0}}, '{_START}') AND NOT regexp_matches({{0}}, '(?i)^define\\s+((a\\s+)?(derived|another))\\b'))"
_WHOLE = "lower(array_to_string({0}, chr(10)))"


def _like(lines: str) -> str:
    whole = _WHOLE.format(lines)
    return f"(length({whole}) >= 30 AND (coalesce({_STARTS.format(lines + '[1]')}, false) OR {_any(whole, '?', '？')}) AND {_any(whole, *ex.QUESTION_MARKERS)} AND NOT starts_with({whole}, '打开文件'))"


def _lines_of(column):
    stripped = F.transform(F.split(F.coalesce(column, F.lit("")), "\r\n|\n|\r"), lambda v: F.regexp_replace(v, r"(?U)^[\s\u001c-\u001f]+|[\s\u001c-\u001f]+$", ""))
    return F.filter(stripped, lambda v: v != "")


@query("f20_question_like", f"SELECT doc_key FROM (SELECT doc_key, {_LINES.replace('{0}', 'raw_text')} AS ls FROM {RAW}) WHERE {_like('ls')}")
def f20_question_like(spark, folder):
    return _raw(spark, folder).where(ex.question_like(_lines_of(F.col("raw_text")))).select("doc_key")


@query(
    "t26_question_blocks",
    f"""WITH d AS (SELECT doc_key, ['第1篇 ' || coalesce(title, '')] || {_LINES.replace('{0}', "raw_text")} AS ls FROM {RAW}),
l AS (SELECT doc_key, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
s AS (SELECT *, regexp_matches(line, '^第[一二三四五六七八九十\\d]+篇') AS sec FROM l), n AS (SELECT *, sum(sec::INT) OVER (PARTITION BY doc_key ORDER BY i) AS sn FROM s),
h AS (SELECT *, first(line) OVER (PARTITION BY doc_key, sn ORDER BY i) AS section FROM n),
o AS (SELECT * FROM h WHERE NOT sec AND NOT regexp_matches(section, '(?i)^第3篇|常见错误')),
b AS (SELECT *, sum({_STARTS.format("line")}::INT) OVER (PARTITION BY doc_key, sn ORDER BY i) AS bn FROM o),
g AS (SELECT doc_key, section, sn, bn, min(i) AS first, max(i) AS last, list(line ORDER BY i) AS ls FROM b GROUP BY ALL)
SELECT doc_key, section, first, last, array_to_string(ls, chr(10)) AS block FROM g WHERE {_like("ls")}""",
)
def t26_question_blocks(spark, folder):
    """Question blocks of every document, its title as the first section."""
    raw = _raw(spark, folder)
    paragraphs = F.concat(F.array(F.concat(F.lit("第1篇 "), F.coalesce("title", F.lit("")))), _lines_of(F.col("raw_text")))
    rows = raw.select("doc_key", F.inline(ex.question_blocks(paragraphs)))
    return rows.select("doc_key", "section", F.col("first").cast("bigint").alias("first"), F.col("last").cast("bigint").alias("last"), F.array_join("lines", "\n").alias("block"))


_HINT = "(^#include\\b|[{};]|\\b(class|struct|template|namespace|void|int|double|char|bool|public|private|protected|virtual|return|cout|cin|main)\\b|//)"
_W = _WHOLE.format("ls")


@query(
    "t25_kinds",
    f"""SELECT question_id, kind, CASE WHEN {_any(_W, *ex.HARD)} THEN 4 ELSE 3 END::BIGINT AS difficulty, CASE kind WHEN 'code_fixing' THEN '错误定位 代码修正' WHEN 'code_reading' THEN '代码阅读 运行结果分析' ELSE '程序设计 代码实现' END AS abilities
FROM (SELECT *, CASE WHEN {_any(_W, *ex.FIXING)} THEN 'code_fixing' WHEN {_any(_W, *ex.READING)} THEN 'code_reading' WHEN {_any(_W, *ex.PROGRAMMING)} THEN 'short_programming' WHEN len(list_filter(ls, lambda x: regexp_matches(x, '{_HINT}'))) > 0 THEN 'code_reading' ELSE 'short_programming' END AS kind
  FROM (SELECT DISTINCT question_id, {_LINES.replace('{0}', "coalesce(stem, '') || chr(10) || coalesce(code, '')")} AS ls FROM questions))""",
)
def t25_kinds(spark, folder):
    """Kind, difficulty and abilities that the wording of each question tells."""
    rows = table(spark, folder, "questions").select("question_id", _lines_of(F.concat_ws("\n", F.coalesce("stem", F.lit("")), F.coalesce("code", F.lit("")))).alias("ls")).distinct()
    kind = ex.question_kind(F.col("ls"))
    return rows.select("question_id", kind.alias("kind"), ex.difficulty(F.col("ls")).cast("bigint").alias("difficulty"), F.array_join(ex.abilities(kind), " ").alias("abilities"))


@query("m13_exercise_records")
def m13_exercise_records(spark, folder):
    """Questions with their code as documents with table cells, parsed anew; a fold, tested on a small fixture."""
    rows = table(spark, folder, "questions").groupBy("question_id").agg(F.min_by(F.struct("stem", "code"), F.struct("ingested_at", "stem")).alias("q")).select(F.col("question_id").alias("doc"), "q.*")
    paragraphs = F.concat(F.array(F.lit("第1篇")), _lines_of(F.col("stem")))
    cells = F.when(F.coalesce("code", F.lit("")) != "", F.array("code")).otherwise(F.array().cast("array<string>"))
    return ex.document_questions(rows, "doc", paragraphs, cells).withColumn("abilities", F.array_join("abilities", " "))
