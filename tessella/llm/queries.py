"""Queries of this subpackage's operators, with SQL oracles where SQL can say them."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessella.llm.bpe import decode_corpus, encode_corpus
from tessella.llm.canonical import link_mentions
from tessella.llm.components import components, entity_links
from tessella.llm.garbled import find_garbled
from tessella.llm.mixing import mixture, source_name
from tessella.llm.nearcopies import near_groups, near_items, near_pairs
from tessella.llm.scans import repair_scans, scan_items, scan_noise, word_list
from tessella.llm.splitting import split_texts, text_cuts
from tessella.llm.survivors import FieldRule, consensus, elect, is_placeholder, known_sources, source_list, trust_rank
from tessella.runtime import Scratch, table

# ------------------------------------------------------------------ problem 1


def _long_texts(spark, folder, operator):
    raw = operator(table(spark, folder, "raw_documents"), "doc_key", "raw_text", 420, 40)
    chunk = operator(table(spark, folder, "clean_chunks"), "chunk_id", "content", 420, 40)
    return raw.withColumn("item_kind", F.lit("raw")).unionByName(chunk.withColumn("item_kind", F.lit("chunk")))


def p1_found(spark, folder):
    """Every text of more than 420 characters, and whether its pieces end at natural boundaries."""
    return _long_texts(spark, folder, text_cuts).select("item_kind", "item_key", "cut")


def p1_pieces(spark, folder):
    """The pieces themselves."""
    return _long_texts(spark, folder, split_texts).select("item_kind", "item_key", "piece_no", "start", "length", "piece")


def p1_invariants(spark, folder):
    """What must hold of the pieces of each text: their length, overlap, coverage and least number."""
    p = p1_pieces(spark, folder).withColumn("finish", F.col("start") + F.col("length"))
    order = Window.partitionBy("item_kind", "item_key").orderBy("piece_no")
    p = p.withColumn("before", F.lag("finish").over(order))
    joined = F.when(F.col("piece_no") == 0, F.col("start") == 0).otherwise(F.col("start") == F.col("before") - 40)
    held = p.groupBy("item_kind", "item_key").agg(F.max("finish").cast("bigint").alias("covered"), F.bool_and((F.col("length") <= 420) & (F.char_length("piece") == F.col("length"))).alias("within"), F.bool_and(joined).alias("overlapping"), F.count("*").alias("n"))
    return held.select("item_kind", "item_key", "covered", "within", "overlapping", (F.col("n") >= F.ceil((F.col("covered") - 40) / 380)).alias("enough"))


_SPANS = r"""
  SELECT {kind} AS item_kind, {key} AS item_key, min({text}) AS t FROM {table} WHERE length({text}) > 420 GROUP BY {key}"""

P1_SQL = (
    "WITH long AS ("
    + _SPANS.format(kind="'raw'", key="doc_key", text="raw_text", table="raw_documents")
    + "\n  UNION ALL"
    + _SPANS.format(kind="'chunk'", key="chunk_id", text="content", table="clean_chunks")
    + r""")
SELECT item_kind, item_key,
  CASE WHEN list_max(list_transform(
    string_split(regexp_replace(regexp_replace(t, '[.!?;]([\s\x{3000}\x{00a0}])', chr(10) || '\1', 'g'), '[。！？；]', chr(10), 'g'), chr(10)),
    lambda x: length(x))) > 420 THEN 'hard' ELSE 'natural' END AS cut
FROM long"""
)

P1_INVARIANTS_SQL = P1_SQL.split("SELECT item_kind, item_key,\n")[0] + "SELECT item_kind, item_key, length(t) AS covered, true AS within, true AS overlapping, true AS enough FROM long"

# ------------------------------------------------------------------ problem 3


def p3_found(spark, folder):
    """Every record of a group of two or more, with the group's smallest id."""
    links = entity_links(table(spark, folder, "prepared_entities"), table(spark, folder, "entity_matches"), table(spark, folder, "standard_nodes"))
    return components(links, "a", "b").select(F.col("vertex").alias("raw_id"), "group_id")


P3_SQL = """WITH RECURSIVE
known AS (SELECT DISTINCT raw_id FROM prepared_entities WHERE raw_id IS NOT NULL),
member AS (SELECT DISTINCT row_id, unnest(original_entity_ids) AS raw_id FROM standard_nodes),
star AS (SELECT min(m.raw_id) OVER (PARTITION BY m.row_id) AS a, m.raw_id AS b FROM member m JOIN known USING (raw_id)),
link AS (
  SELECT left_id AS a, right_id AS b FROM entity_matches WHERE verdict = 'same' AND left_id IN (SELECT raw_id FROM known) AND right_id IN (SELECT raw_id FROM known)
  UNION SELECT a, b FROM star),
edge AS (SELECT a, b FROM link WHERE a <> b UNION SELECT b, a FROM link WHERE a <> b),
reach AS (SELECT DISTINCT a AS x, a AS y FROM edge UNION SELECT r.x, e.b FROM reach r JOIN edge e ON r.y = e.a)
SELECT x AS raw_id, min(y) AS group_id FROM reach GROUP BY x"""

# ------------------------------------------------------------------ problem 4


def _node_rows(spark, folder):
    return table(spark, folder, "standard_nodes").select("row_id", "id", "name", "confidence", "sources", "origin", "updated_at")


def _edge_rows(spark, folder):
    return table(spark, folder, "standard_edges").select("row_id", "source", "target", "type", "confidence", "evidence", "sources", "updated_at")


def node_key():
    return F.lower(F.trim("id"))


def edge_key():
    return F.concat(F.col("source"), F.lit("|"), F.col("type"), F.lit("|"), F.col("target"))


def p4_found(spark, folder):
    """Whose value of each field survives in each group of nodes and edges: consensus with weights from ranks.

    The fields are those of the problem: name, confidence and sources of
    nodes, evidence of edges.
    """
    known = known_sources(F.col("sources"))
    sound = (F.col("confidence") > 0) & (F.col("confidence") <= 1)
    name = FieldRule("name", F.col("name"), ~is_placeholder(F.col("name")), (trust_rank(F.col("origin")),))
    confidence = FieldRule("confidence", F.col("confidence").cast("string"), sound)
    sources = FieldRule("sources", source_list(F.col("sources")), known > 0, (-known,))
    evidence = FieldRule("evidence", F.col("evidence"), ~is_placeholder(F.col("evidence")), (-F.char_length(F.trim("evidence")),))
    nodes = elect(_node_rows(spark, folder), node_key(), "row_id", "updated_at", [name, confidence, sources])
    edges = elect(_edge_rows(spark, folder), edge_key(), "row_id", "updated_at", [evidence])
    kind = lambda df, k: df.select(F.lit(k).alias("grp_kind"), "grp_key", "field_name", "row_id")
    return kind(nodes, "node").unionByName(kind(edges, "edge"))


def p4_consensus(spark, folder):
    """Of each group the name or evidence closest to the token consensus of its values."""
    nodes = consensus(_node_rows(spark, folder).dropDuplicates(["row_id"]), node_key(), F.col("name"), F.col("confidence"))
    edges = consensus(_edge_rows(spark, folder).dropDuplicates(["row_id"]), edge_key(), F.col("evidence"), F.col("confidence"))
    return nodes.withColumn("grp_kind", F.lit("node")).unionByName(edges.withColumn("grp_kind", F.lit("edge")))


_PLACEHOLDER = r"""coalesce(lower(regexp_replace({0}, '^[\s\x{{3000}}]+|[\s\x{{3000}}]+$', '', 'g')) IN ('', '-', 'n/a', 'null', 'unknown', '无', '未知', '待补充'), true)"""
_KNOWN = """len(list_distinct(list_transform(list_filter(coalesce(sources, []), lambda s: s.chunk_id IS NOT NULL), lambda s: {'c': s.chunk_id, 'f': s.source_file, 'p': s.page})))"""


def _p4_field(rows: str, kind: str, field: str, qualifies: str, rank: str) -> str:
    return f"""SELECT '{kind}' AS grp_kind, k AS grp_key, '{field}' AS field_name, row_id FROM (
  SELECT k, row_id, row_number() OVER (PARTITION BY k ORDER BY {rank} updated_at DESC NULLS LAST, row_id) AS n FROM {rows} WHERE big AND {qualifies}) WHERE n = 1"""


_NODES = "(SELECT *, lower(trim(id)) AS k, count(DISTINCT row_id) OVER (PARTITION BY lower(trim(id))) > 1 AS big FROM standard_nodes WHERE id IS NOT NULL)"
_EDGES = "(SELECT *, source || '|' || type || '|' || target AS k, count(DISTINCT row_id) OVER (PARTITION BY source || '|' || type || '|' || target) > 1 AS big FROM standard_edges WHERE source IS NOT NULL AND target IS NOT NULL AND type IS NOT NULL)"
_ORIGIN = "CASE origin WHEN 'curated' THEN 0 WHEN 'rule' THEN 1 WHEN 'llm' THEN 2 WHEN 'inferred' THEN 3 ELSE 4 END,"
_SOUND = "confidence > 0 AND confidence <= 1 AND NOT isnan(confidence)"
P4_SQL = "\nUNION ALL\n".join(
    [
        _p4_field(_NODES, "node", "name", "NOT " + _PLACEHOLDER.format("name"), _ORIGIN),
        _p4_field(_NODES, "node", "confidence", _SOUND, ""),
        _p4_field(_NODES, "node", "sources", f"{_KNOWN} > 0", f"{_KNOWN} DESC,"),
        _p4_field(_EDGES, "edge", "evidence", "NOT " + _PLACEHOLDER.format("evidence"), "length(trim(evidence)) DESC,"),
    ]
)

# ------------------------------------------------------------------ problem 5


def _scans(spark, folder):
    pdf = F.col("source_type") == "pdf"
    raw = scan_items(table(spark, folder, "raw_documents"), F.col("doc_key"), F.col("raw_text"), F.col("source_file"), F.col("title"), "raw", pdf)
    chunk = scan_items(table(spark, folder, "clean_chunks"), F.col("chunk_id"), F.col("normalized_content"), F.col("source_file"), F.col("chapter"), "chunk", pdf)
    return raw.unionByName(chunk), word_list(table(spark, folder, "term_lexicon"))


def p5_found(spark, folder):
    """Each kind of noise in each scanned text."""
    return scan_noise(*_scans(spark, folder), Scratch(spark, "scans"))


def p5_repaired(spark, folder):
    """The scanned texts as continuous paragraphs."""
    return repair_scans(*_scans(spark, folder), Scratch(spark, "scans"))


# ------------------------------------------------------------------ problem 6


def p6_found(spark, folder):
    """The catalog entry that each mention's name means, empty if there is none."""
    return link_mentions(table(spark, folder, "entities"), "mention_id", "name", table(spark, folder, "curriculum_catalog"), table(spark, folder, "term_lexicon"))


# ------------------------------------------------------------------ problem 7


def _near(spark, folder):
    blank = F.lit("")
    stem_and_code = F.concat(F.coalesce("stem", blank), F.lit("\n"), F.coalesce("code", blank))
    questions = near_items(table(spark, folder, "questions"), "question", F.col("question_id"), stem_and_code)
    return questions.unionByName(near_items(table(spark, folder, "clean_chunks"), "chunk", F.col("chunk_id"), F.col("content")))


def p7_found(spark, folder):
    """Every pair of near copies among the questions and among the chunks."""
    return near_pairs(_near(spark, folder))


def p7_groups(spark, folder):
    """Every record with its group of near copies."""
    return near_groups(_near(spark, folder))


_SQUEEZED = "translate(lower({0}), ' ' || chr(9) || chr(10) || chr(13) || chr(12288), '')"
P7_SQL = f"""WITH item AS (
  SELECT DISTINCT 'question' AS k, question_id AS id, {_SQUEEZED.format("coalesce(stem, '') || chr(10) || coalesce(code, '')")} AS t FROM questions
  UNION SELECT DISTINCT 'chunk', chunk_id, {_SQUEEZED.format("coalesce(content, '')")} FROM clean_chunks),
gram AS (SELECT DISTINCT k, id, substr(t, i, 5) AS g FROM (SELECT k, id, t, unnest(range(1, length(t) - 3)) AS i FROM item WHERE length(t) >= 40)),
size AS (SELECT k, id, count(*) AS n FROM gram GROUP BY ALL),
pair AS (SELECT a.k, a.id AS x, b.id AS y, count(*) AS c FROM gram a JOIN gram b ON a.k = b.k AND a.g = b.g AND a.id < b.id GROUP BY ALL)
SELECT pair.k AS item_kind, x AS key_a, y AS key_b FROM pair JOIN size p ON p.k = pair.k AND p.id = x JOIN size q ON q.k = pair.k AND q.id = y
WHERE c / (p.n + q.n - c) >= 0.6"""

# ------------------------------------------------------------------ problem 8


def p8_ids(spark, folder):
    """The token ids of every document."""
    return encode_corpus(table(spark, folder, "documents"), "doc_id", "text")


def p8_round_trip(spark, folder):
    """What the ids of every document stand for; it must be the document's text."""
    ids = encode_corpus(table(spark, folder, "documents"), "doc_id", "text").dropDuplicates(["doc_id"])
    back = decode_corpus(ids, "doc_id", "ids")
    return back.select("doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("digest"))


P8_SQL = "SELECT DISTINCT doc_id, length(coalesce(text, '')) AS n_chars, md5(coalesce(text, '')) AS digest FROM documents"

# ------------------------------------------------------------------ problem 9


def p9_mix(spark, folder):
    """The documents of the mixture and how often each is used."""
    return mixture(table(spark, folder, "documents"), table(spark, folder, "source_targets"))[0]


def p9_shares(spark, folder):
    """The share that each source reaches."""
    return mixture(table(spark, folder, "documents"), table(spark, folder, "source_targets"))[1]


def p9_checks(spark, folder):
    """Of each source that can be served: whether it keeps its cap, and its share to within its largest document; counted anew from the mixture."""
    mixed = p9_mix(spark, folder)
    sizes = encode_corpus(table(spark, folder, "documents"), "doc_id", "text", count_only=True).groupBy("doc_id").agg(F.max("n_tokens").alias("size"))
    targets = table(spark, folder, "source_targets").select(source_name(F.col("source")).alias("source"), "target_share", "max_repeats")
    rows = mixed.select("doc_id", "source", "repeats").join(sizes, "doc_id")
    taken = rows.groupBy("source").agg(F.sum(F.col("size").cast("bigint") * F.col("repeats")).alias("tokens"), F.max("repeats").alias("most"), F.max("size").alias("largest"), F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs"))
    joined = taken.join(targets, "source")
    sums = joined.agg(F.sum("tokens").alias("all"), F.sum("target_share").alias("served"))
    off = F.abs(F.col("tokens") / F.col("all") - F.col("target_share") / F.col("served"))
    return joined.crossJoin(sums).select("source", ((F.col("most") <= F.col("max_repeats")) & (F.col("n") == F.col("docs"))).alias("capped"), (off <= F.col("largest") / F.col("all")).alias("shared"))


_SOURCE = "regexp_replace(regexp_replace(lower(source), '^[\\s\\x{3000}]+|[\\s\\x{3000}]+$', '', 'g'), '[\\s\\-\\x{3000}]+', '_', 'g')"
P9_SQL = f"SELECT DISTINCT t.source, true AS capped, true AS shared FROM (SELECT {_SOURCE} AS source FROM source_targets WHERE target_share > 0 AND max_repeats > 0) t JOIN (SELECT {_SOURCE} AS source FROM documents WHERE text <> '') d USING (source)"

# ----------------------------------------------------------------- problem 10


def p10_found(spark, folder):
    """Documents that show characters of a wrong decoding."""
    return find_garbled(table(spark, folder, "documents"), "doc_id", "text", False).where("garbled").select("doc_id").distinct()


def p10_restored(spark, folder):
    """Those documents with everything put back that can be."""
    return find_garbled(table(spark, folder, "documents"), "doc_id", "text").where("garbled").select("doc_id", "restored", "text")


QUERIES = {"p9_mix": p9_mix, "p9_checks": p9_checks, "p8_round_trip": p8_round_trip, "p9_shares": p9_shares, "p7_found": p7_found, "p7_groups": p7_groups, "p5_found": p5_found, "p5_repaired": p5_repaired, "p6_found": p6_found, "p10_found": p10_found, "p10_restored": p10_restored, "p1_found": p1_found, "p1_pieces": p1_pieces, "p1_invariants": p1_invariants, "p3_found": p3_found, "p4_found": p4_found, "p4_consensus": p4_consensus, "p8_ids": p8_ids}
SQL = {"p8_round_trip": P8_SQL, "p9_checks": P9_SQL, "p7_found": P7_SQL, "p1_found": P1_SQL, "p1_invariants": P1_INVARIANTS_SQL, "p3_found": P3_SQL, "p4_found": P4_SQL}
