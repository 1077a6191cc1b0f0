"""Text and extraction queries over raw documents, chunks and entities, with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.functions import coerce as k
from tessella.operators import cleaning as c
from tessella.operators import extraction as x
from tessella.runtime import table
from tessella.vocabulary import BACKGROUND, CONCEPTS, KEYWORDS, ROLES, STRONG_KEYWORDS, SYNTAX, TERMS, WEAK_KEYWORDS

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def _raw(spark, folder):
    return table(spark, folder, "raw_documents").dropDuplicates(["doc_key"])


def _chunks(spark, folder):
    return table(spark, folder, "clean_chunks").dropDuplicates(["chunk_id"])


RAW = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_key) AS k FROM raw_documents) WHERE k = 1)"
CHUNKS = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id) AS k FROM clean_chunks) WHERE k = 1)"
_SPLIT = "string_split_regex({0}, '\\r\\n|[\\n\\r\\x{{0085}}\\x{{2028}}\\x{{2029}}\\x0b\\x0c\\x1c\\x1d\\x1e]')"
_PLAIN = "regexp_replace(replace(coalesce(raw_text, ''), '　', ' '), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g')"
_WS = "[\\s\\x0b\\x1c-\\x1f\\x{0085}\\x{00a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
_LINES = f"list_transform({_SPLIT.format(_PLAIN)}, lambda x: trim(regexp_replace(x, '{_WS}+', ' ', 'g')))"
_NOISE = "'(?i)^(\\d+|第\\s*\\d+\\s*页|page\\s*\\d+|目录|contents?|thank\\s+you|谢谢观看|参考文献|references?)$'"
_CLEAN = f"array_to_string(list_filter({_LINES}, lambda x: x <> '' AND NOT regexp_matches(x, {_NOISE})), chr(10))"


def _in(low: str, words) -> str:
    return " + ".join(f"contains({low}, {_q(w.lower())})::INT" for w in words)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _any(low: str, *words) -> str:
    return "(" + " OR ".join(f"contains({low}, {_q(w)})" for w in words) + ")"


@query("t1_clean", f"SELECT doc_key, {_CLEAN} AS cleaned FROM {RAW}")
def t1_clean(spark, folder):
    return _raw(spark, folder).select("doc_key", c.clean_text(F.col("raw_text")).alias("cleaned"))


@query("t2_noise_lines", f"SELECT doc_key, len(list_filter({_LINES}, lambda x: regexp_matches(x, {_NOISE})))::BIGINT AS noise FROM {RAW}")
def t2_noise_lines(spark, folder):
    return _raw(spark, folder).select("doc_key", F.size(F.filter(c.lines_of(F.col("raw_text")), c.is_noise_line)).cast("bigint").alias("noise"))


@query("t3_title", f"SELECT doc_key, coalesce(substr(list_filter(list_transform({_SPLIT.format('coalesce(raw_text, chr(32))')}, lambda x: regexp_replace(x, '^{_WS}+|{_WS}+$', '', 'g')), lambda x: x <> '')[1], 1, 60), '') AS title FROM {RAW}")
def t3_title(spark, folder):
    return _raw(spark, folder).select("doc_key", c.guess_title(F.col("raw_text")).alias("title"))


@query("t8_location", f"SELECT doc_key, CASE WHEN page IS NOT NULL THEN '第' || page || '页' WHEN trim(coalesce(question_id, '')) <> '' THEN '第' || trim(question_id) || '题' ELSE '全文' END AS location FROM {RAW}")
def t8_location(spark, folder):
    return _raw(spark, folder).select("doc_key", c.evidence_location(F.col("page"), F.col("question_id")).alias("location"))


_terms = "content"
for _old, _new in TERMS:
    _terms = f"regexp_replace({_terms}, {_q(_old)}, {_q(_new)}, 'gi')"


@query("t9_terms", f"SELECT chunk_id, {_terms} AS normal FROM {CHUNKS}")
def t9_terms(spark, folder):
    return _chunks(spark, folder).select("chunk_id", c.normal_terms(F.col("content")).alias("normal"))


_LOW = "lower(coalesce(content, ''))"
_BOTH_LOW = "lower(coalesce(source_file, '') || chr(10) || coalesce(content, ''))"
_LANG = f"CASE WHEN {_any(_BOTH_LOW, 'java', 'extends', 'implements')} THEN 'Java' WHEN {_any(_BOTH_LOW, 'python', '__init__', 'self.')} THEN 'Python' WHEN {_any(_BOTH_LOW, 'c++', 'virtual', '::')} THEN 'C++' ELSE '通用OOP' END"


@query("t10_language", f"SELECT chunk_id, {_LANG} AS found FROM {CHUNKS}")
def t10_language(spark, folder):
    return _chunks(spark, folder).select("chunk_id", c.language(F.col("source_file"), F.col("content")).alias("found"))


_R = {r: f"({_in(_LOW, ws)})" for r, ws in ROLES.items()}
_MOST = f"greatest({', '.join(_R.values())})"
_ROLE = f"CASE WHEN {_MOST} = 0 THEN 'concept_explanation' " + " ".join(f"WHEN {e} = {_MOST} THEN '{r}'" for r, e in _R.items()) + " END"


@query("t11_role", f"SELECT chunk_id, CASE WHEN source_type = 'exercise' THEN 'exercise' ELSE {_ROLE} END AS role FROM {CHUNKS}")
def t11_role(spark, folder):
    return _chunks(spark, folder).select("chunk_id", c.role(F.col("content"), F.col("source_type")).alias("role"))


_B = "(coalesce(chapter, '') || ' ' || coalesce(content, ''))"


@query(
    "t12_chapter",
    f"""SELECT chunk_id, CASE WHEN {_any(_B, "继承", "extends")} THEN '面向对象编程-继承' WHEN {_any(_B, "多态")} OR {_any(f"lower({_B})", "polymorphism")} THEN '面向对象编程-多态'
  WHEN {_any(_B, "接口")} OR {_any(f"lower({_B})", "interface")} THEN '面向对象编程-接口' WHEN {_any(_B, "封装")} OR {_any(f"lower({_B})", "private", "protected")} THEN '面向对象编程-封装'
  WHEN {_any(_B, "构造")} OR {_any(f"lower({_B})", "constructor")} THEN '面向对象编程-构造方法' WHEN {_any(_B, "类", "对象")} OR {_any(f"lower({_B})", "class")} THEN '面向对象编程-类与对象' ELSE '面向对象编程' END AS topic FROM {CHUNKS}""",
)
def t12_chapter(spark, folder):
    return _chunks(spark, folder).select("chunk_id", c.chapter(F.col("chapter"), F.col("content")).alias("topic"))


_KW = f"list_filter([{', '.join(_q(w) for w in sorted(KEYWORDS, key=lambda w: (len(w), w)))}], lambda w: contains({_LOW}, lower(w)))"


@query("f1_keywords", f"SELECT chunk_id, array_to_string({_KW}, ' ') AS words FROM {CHUNKS}")
def f1_keywords(spark, folder):
    return _chunks(spark, folder).select("chunk_id", F.array_join(c.matched_keywords(F.col("content")), " ").alias("words"))


@query("t13_section", f"SELECT chunk_id, CASE WHEN coalesce(section, '') <> '' THEN section WHEN len({_KW}) > 0 THEN array_to_string({_KW}[1:3], '、') ELSE '未标注小节' END AS shown FROM {CHUNKS}")
def t13_section(spark, folder):
    return _chunks(spark, folder).select("chunk_id", c.section(F.col("section"), c.matched_keywords(F.col("content"))).alias("shown"))


@query("t14_hint", f"SELECT chunk_id, least(55 + 15 * (len({_KW}) >= 2)::INT + 15 * {_any('content', 'class', 'extends', 'implements', '接口', '继承', '多态', '封装')}::INT + 10 * (length(content) >= 25)::INT, 95) / 100 AS hint FROM {CHUNKS} WHERE content IS NOT NULL")
def t14_hint(spark, folder):
    return _chunks(spark, folder).where("content IS NOT NULL").select("chunk_id", c.confidence_hint(F.col("content"), c.matched_keywords(F.col("content"))).alias("hint"))


_SCORE = f"(({_in(_LOW, STRONG_KEYWORDS)}) * 3 + least({_in(_LOW, WEAK_KEYWORDS)}, 3) + 2 * regexp_matches(coalesce(content, ''), '(?i)\\b(class|interface|extends|implements)\\s+[A-Za-z_]\\w*|\\babstract\\s+class\\b|\\b(this|super)\\.')::INT - 5 * (({_in(_LOW, BACKGROUND)}) > 0)::INT)"


@query("f2_relevance", f"SELECT chunk_id, {_SCORE}::BIGINT AS score FROM {CHUNKS}")
def f2_relevance(spark, folder):
    return _chunks(spark, folder).select("chunk_id", c.relevance(F.col("content")).cast("bigint").alias("score"))


@query("f4_kept_chunks", f"SELECT chunk_id FROM {CHUNKS} WHERE {_SCORE} >= CASE WHEN source_type = 'exercise' THEN 2 ELSE 3 END AND len({_KW}) > 0")
def f4_kept_chunks(spark, folder):
    rows = _chunks(spark, folder).where((c.relevance(F.col("content")) >= F.when(F.col("source_type") == "exercise", 2).otherwise(3)) & (F.size(c.matched_keywords(F.col("content"))) > 0))
    return rows.select("chunk_id")


@query("f9_code", f"SELECT chunk_id FROM {CHUNKS} WHERE regexp_matches(coalesce(content, ''), '\\b(class|interface|extends|implements|public|private|protected|void|new)\\b|[{{}};]')")
def f9_code(spark, folder):
    return _chunks(spark, folder).where(x.looks_like_code(F.col("content"))).select("chunk_id")


@query(
    "t5_blocks",
    f"""WITH l AS (SELECT doc_key, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT doc_key, string_split({_CLEAN}, chr(10)) AS ls FROM {RAW})),
m AS (SELECT doc_key, line, i, sum(CASE WHEN regexp_matches(line, '^([\\-*•]|\\d+[.)、]|[A-D][.)、])') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_key ORDER BY i) AS b FROM l WHERE line <> '')
SELECT doc_key, string_agg(line, ' ' ORDER BY i) AS block FROM m GROUP BY doc_key, b""",
)
def t5_blocks(spark, folder):
    return _raw(spark, folder).select("doc_key", F.explode(c.blocks(c.clean_text(F.col("raw_text")))).alias("block"))


@query("m3_preprocess")
def m3_preprocess(spark, folder):
    """The whole way from raw texts to labelled chunks."""
    return c.preprocess(table(spark, folder, "raw_documents")).withColumn("keywords", F.array_join("keywords", " "))


@query(
    "t4_chunks",
    f"""WITH d AS (SELECT doc_key, source_type, {_CLEAN} AS cleaned FROM {RAW}),
l AS (SELECT doc_key, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT doc_key, string_split(cleaned, chr(10)) AS ls FROM d WHERE source_type IS DISTINCT FROM 'exercise')),
m AS (SELECT doc_key, line, i, sum(CASE WHEN regexp_matches(line, '^([\\-*•]|\\d+[.)、]|[A-D][.)、])') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_key ORDER BY i) AS b FROM l WHERE line <> ''),
g AS (SELECT doc_key, b, trim(string_agg(line, ' ' ORDER BY i)) AS block FROM m GROUP BY doc_key, b),
p AS (SELECT doc_key, b, block, list_reduce(list_transform(list_filter(string_split(regexp_replace(block, '([。！？.!?])[\\s\\x0b]+', '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> ''), lambda x: {{'done': []::VARCHAR[], 'open': x}}),
  lambda a, x: CASE WHEN length(a.open) + length(x.open) > 420 AND a.open <> '' THEN {{'done': list_append(a.done, a.open), 'open': x.open}} ELSE {{'done': a.done, 'open': CASE WHEN a.open = '' THEN x.open ELSE a.open || ' ' || x.open END}} END) AS f FROM g WHERE block <> ''),
c AS (SELECT doc_key, b, unnest(cs) AS content, generate_subscripts(cs, 1) AS j FROM (SELECT doc_key, b, CASE WHEN length(block) <= 420 THEN [block] ELSE list_append(f.done, f.open) END AS cs FROM p) UNION ALL SELECT doc_key, 0, cleaned, 1 FROM d WHERE source_type = 'exercise')
SELECT doc_key, row_number() OVER (PARTITION BY doc_key ORDER BY b, j) - 1 AS chunk_no, trim(content) AS content FROM c WHERE length(trim(content)) >= 8""",
)
def t4_chunks(spark, folder):
    """Chunks of every text, before any filter."""
    rows = _raw(spark, folder).select("doc_key", "source_type", c.clean_text(F.col("raw_text")).alias("cleaned"))
    return rows.select("doc_key", F.posexplode(c.chunk_texts(F.col("cleaned"), F.col("source_type"))).alias("chunk_no", "content"))


_ID = "[A-Za-z_]\\w*"


@query(
    "c11_structures",
    f"""SELECT chunk_id, unnest(regexp_extract_all(content, '\\bclass\\s+({_ID})', 1)) AS name, 'class' AS kind FROM {CHUNKS}
UNION ALL SELECT chunk_id, unnest(regexp_extract_all(content, '\\binterface\\s+({_ID})', 1)), 'interface' FROM {CHUNKS}
UNION ALL SELECT chunk_id, unnest(regexp_extract_all(content, '\\b(?:public|private|protected)?\\s*(?:static\\s+)?(?:void|int|String|boolean|double|float|char)\\s+({_ID})\\s*\\(', 1)), 'method' FROM {CHUNKS}""",
)
def c11_structures(spark, folder):
    return x.structures(_chunks(spark, folder))


@query("c11_links", f"SELECT chunk_id, r.h AS head, 'inherits_from' AS relation, r.t AS tail FROM (SELECT chunk_id, unnest(list_zip(regexp_extract_all(content, '\\bclass\\s+({_ID})\\s+extends\\s+({_ID})', 1), regexp_extract_all(content, '\\bclass\\s+({_ID})\\s+extends\\s+({_ID})', 2))) AS p FROM {CHUNKS}), LATERAL (SELECT p[1] AS h, p[2] AS t) r UNION ALL SELECT chunk_id, p[1], 'implements_interface', p[2] FROM (SELECT chunk_id, unnest(list_zip(regexp_extract_all(content, '\\bclass\\s+({_ID})\\s+implements\\s+({_ID})', 1), regexp_extract_all(content, '\\bclass\\s+({_ID})\\s+implements\\s+({_ID})', 2))) AS p FROM {CHUNKS})")
def c11_links(spark, folder):
    return x.structure_links(_chunks(spark, folder))


@query("c11_syntax", f"SELECT chunk_id, array_to_string(list_filter([{', '.join(_q(w) for w in sorted(SYNTAX, key=lambda w: (len(w), w)))}], lambda w: regexp_matches({_LOW}, '(^|[^\\p{{L}}\\p{{N}}_\\p{{M}}])' || w || '($|[^\\p{{L}}\\p{{N}}_\\p{{M}}])')), ' ') AS words FROM {CHUNKS}")
def c11_syntax(spark, folder):
    return _chunks(spark, folder).select("chunk_id", F.array_join(x.syntax_in(F.col("content")), " ").alias("words"))


@query("c11_concepts", f"SELECT chunk_id, array_to_string(list_filter([{', '.join(_q(w) for w in sorted(CONCEPTS, key=lambda w: (len(w), w)))}], lambda w: contains(coalesce(content, ''), w)), ' ') AS words FROM {CHUNKS}")
def c11_concepts(spark, folder):
    return _chunks(spark, folder).select("chunk_id", F.array_join(x.concepts_in(F.coalesce("content", F.lit(""))), " ").alias("words"))


_SOUND = "CASE WHEN confidence > 0 AND confidence <= 1 AND NOT isnan(confidence) THEN confidence END"


@query(
    "a4_entity_merge",
    f"""WITH m AS (SELECT name, type, count(DISTINCT mention_id) AS mentions, round(coalesce(max({_SOUND}), 0.0), 4) AS confidence,
  first(description ORDER BY length(description) DESC, mention_id) FILTER (WHERE description IS NOT NULL) AS description FROM entities WHERE name IS NOT NULL GROUP BY name, type),
ch AS (SELECT name, type, count(DISTINCT c) AS chunks FROM (SELECT name, type, unnest(source_chunk_ids) AS c FROM entities) GROUP BY ALL),
so AS (SELECT name, type, count(DISTINCT {{'c': s.chunk_id, 'f': s.source_file, 'p': s.page}}) AS sources FROM (SELECT name, type, unnest(sources) AS s FROM entities) GROUP BY ALL)
SELECT m.name, m.type, mentions, confidence, description, coalesce(chunks, 0) AS chunks, coalesce(sources, 0) AS sources FROM m
LEFT JOIN ch ON ch.name = m.name AND ch.type IS NOT DISTINCT FROM m.type LEFT JOIN so ON so.name = m.name AND so.type IS NOT DISTINCT FROM m.type""",
)
def a4_entity_merge(spark, folder):
    return x.merge_mentions(table(spark, folder, "entities"))


@query("c1_confidence", "SELECT mention_id, CASE WHEN confidence IS NULL THEN 0.5 WHEN isnan(confidence) THEN 0.0 ELSE greatest(0.0, least(confidence, 1.0)) END AS confidence FROM (SELECT mention_id, max(confidence) AS confidence FROM entities GROUP BY mention_id)")
def c1_confidence(spark, folder):
    rows = table(spark, folder, "entities").groupBy("mention_id").agg(F.max("confidence").alias("confidence"))
    return rows.select("mention_id", k.safe_float(F.col("confidence"), 0.5).alias("confidence"))


@query("c6_fingerprint", "SELECT raw_id, regexp_replace(lower(coalesce(name, '')), '[\\s_\\-·.。,:：;；()（）\\[\\]【】{}<>《》/\\\\]+', '', 'g') AS print FROM (SELECT DISTINCT raw_id, name FROM prepared_entities)")
def c6_fingerprint(spark, folder):
    return table(spark, folder, "prepared_entities").select("raw_id", "name").distinct().select("raw_id", k.fingerprint(F.col("name")).alias("print"))


@query("c8_strength", "SELECT mention_id, CASE WHEN confidence IS NULL OR isnan(confidence) OR confidence < 0 THEN 64 ELSE greatest(45, least(95, round_even(CASE WHEN confidence <= 1 THEN confidence * 100 ELSE confidence END, 0))) END::BIGINT AS strength FROM (SELECT mention_id, max(confidence) AS confidence FROM entities GROUP BY mention_id)")
def c8_strength(spark, folder):
    rows = table(spark, folder, "entities").groupBy("mention_id").agg(F.max("confidence").alias("confidence"))
    return rows.select("mention_id", k.strength(F.col("confidence")).cast("bigint").alias("strength"))


@query("c9_hash_ids", "SELECT DISTINCT name, type, 'ent_' || substr(md5(type || ':' || name), 1, 12) AS id, 'edge_' || substr(sha256(type || ':' || name), 1, 16) AS wide FROM entities WHERE name IS NOT NULL AND type IS NOT NULL")
def c9_hash_ids(spark, folder):
    rows = table(spark, folder, "entities").where("name IS NOT NULL AND type IS NOT NULL").select("name", "type").distinct()
    return rows.select("name", "type", k.hash_id("ent", F.col("type"), F.col("name")).alias("id"), k.wide_hash_id("edge", F.col("type"), F.col("name")).alias("wide"))


@query("c13_evidence", f"SELECT chunk_id, substr(regexp_replace(regexp_replace(coalesce(content, ''), '{_WS}+', ' ', 'g'), '^ +| +$', '', 'g'), 1, 120) AS evidence FROM {CHUNKS}")
def c13_evidence(spark, folder):
    return _chunks(spark, folder).select("chunk_id", k.short_evidence(F.col("content")).alias("evidence"))


@query("f8_thresholds", f"SELECT type, count_if(c >= 0.55)::BIGINT AS kept, count_if(c < 0.55)::BIGINT AS rejected, count_if(c >= 0.85)::BIGINT AS sure FROM (SELECT mention_id, any_value(type) AS type, coalesce(max({_SOUND}), 0.0) AS c FROM entities GROUP BY mention_id) GROUP BY type")
def f8_thresholds(spark, folder):
    sound = F.when((F.col("confidence") > 0) & (F.col("confidence") <= 1), F.col("confidence"))
    rows = table(spark, folder, "entities").groupBy("mention_id").agg(F.first("type").alias("type"), F.coalesce(F.max(sound), F.lit(0.0)).alias("c"))
    return rows.groupBy("type").agg(F.count_if(F.col("c") >= 0.55).alias("kept"), F.count_if(F.col("c") < 0.55).alias("rejected"), F.count_if(F.col("c") >= 0.85).alias("sure"))
