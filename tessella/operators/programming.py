"""Preprocessing against a catalog: what counts is whether a text speaks of the catalog's entries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.coerce import text
from tessella.functions.text import fixed
from tessella.operators.cleaning import chunk_id, chunk_texts, clean_text, evidence_location, language, normal_terms, role, section
from tessella.operators.curriculum import text_matches

#: Shapes of program text in any language, names of languages, words of pages about the course itself.
CODE_SHAPES = (
    r"(?i)\b(class|struct|template|namespace|public|private|protected)\b|\b(if|else|for|while|switch|return|break|continue)\b"
    r"|\b(try|catch|throw|except|raise|import|def)\b|[#{};]|\b(int|double|char|bool|void|string)\b"
)
LANGUAGE_MARKERS = ("java", "python", "c++", "c#", "cpp")
ABOUT_COURSE = ("课程安排", "课程目标", "参考教材", "成绩评定", "发展历史", "作者", "版本历史", "参考文献")
UNPLACED = "未归类编程内容"


def relevance(content: Column, n_matches: Column) -> Column:
    """Two for each of up to four entries, two for code, one for a language, minus three for course talk below four."""
    low = F.lower(F.coalesce(content, F.lit("")))
    has = lambda ws: reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in ws]).cast("int")
    score = F.least(F.coalesce(n_matches, F.lit(0)), F.lit(4)) * 2 + F.rlike(F.coalesce(content, F.lit("")), F.lit(CODE_SHAPES)).cast("int") * 2 + has(LANGUAGE_MARKERS)
    return (score - F.when(score < 4, has(ABOUT_COURSE) * 3).otherwise(0)).cast("int")


def keep_page(source_type: Column, content: Column, score: Column) -> Column:
    """Exercises are kept if they have a text, other pages from a score of two."""
    return F.when(source_type == "exercise", content != "").otherwise(score >= 2)


def keep_chunk(source_type: Column, score: Column) -> Column:
    return score >= F.when(source_type.isin("exercise", "docx"), 1).otherwise(2)


def domain_candidates(texts: DataFrame, key: str, content: str, catalog: DataFrame, tree: DataFrame, most: int = 30) -> DataFrame:
    """(key, domains): names of the top-level entries above the ``most`` longest matches of a text, each once, in that order.

    ``tree`` is the resolved hierarchy of the catalog (id, path).
    """
    names = catalog.select(F.col("id").alias("top"), F.col("name").alias("domain"))
    tops = tree.where(F.size("path") >= 2).select("id", F.col("path")[1].alias("top")).join(names, "top").where("domain <> ''").select("id", "domain")
    hits = text_matches(texts, key, content, catalog, most).join(F.broadcast(tops), "id")
    first = hits.groupBy(key, "domain").agg(F.min("place").alias("place"))
    return first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "domain"))), lambda x: x["domain"]).alias("domains"))


def confidence_hint(n_domains: Column, content: Column) -> Column:
    hundredths = 55 + 10 * F.least(n_domains, F.lit(3)) + F.when(F.char_length(content) >= 25, 10).otherwise(0)
    return F.least(hundredths, F.lit(95)) / 100


def preprocess_programming(raw: DataFrame, catalog: DataFrame, tree: DataFrame) -> DataFrame:
    """Raw texts to labelled chunks with the catalog as filter and labeller.

    Rows delivered twice count once (by doc_key).  Matches are found by one
    automaton pass over pages and one over chunks.
    """
    names = catalog.select("id", "name")
    once = fixed(raw.select("doc_key", "source_file", "source_type", "page", "question_id", "title", "raw_text"), cleaned=clean_text(F.col("raw_text"))).where("cleaned <> ''").drop("raw_text").dropDuplicates(["doc_key"])
    counted = text_matches(once, "doc_key", "cleaned", catalog).groupBy("doc_key").agg(F.count("*").cast("int").alias("n"))
    pages = once.join(counted, "doc_key", "left").where(keep_page(F.col("source_type"), F.col("cleaned"), relevance(F.col("cleaned"), F.col("n")))).drop("n")
    asked = text(F.col("question_id"))
    location = F.when(asked != "", asked).otherwise(F.coalesce(F.col("page").cast("string"), F.lit("doc")))
    cut = pages.select("doc_key", "source_file", "source_type", "page", "question_id", "title", F.posexplode(chunk_texts(F.col("cleaned"), F.col("source_type"))).alias("at", "content"))
    cut = cut.withColumn("piece", F.concat_ws("\u0001", "doc_key", F.col("at").cast("string")))
    found = text_matches(cut, "piece", "content", catalog).join(F.broadcast(names), "id").groupBy("piece").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "name"))), lambda x: x["name"]).alias("keywords"), F.count("*").cast("int").alias("n"))
    kept = cut.join(found, "piece").where(keep_chunk(F.col("source_type"), relevance(F.col("content"), F.col("n"))))
    titled = kept.select("piece", F.concat_ws("\n", F.coalesce("title", F.lit("")), "content").alias("both"))
    domains = domain_candidates(titled, "piece", "both", catalog, tree)
    rows = kept.join(domains, "piece", "left").withColumn("domains", F.coalesce("domains", F.array().cast("array<string>")))
    return rows.select(
        chunk_id(F.col("source_file"), location, F.col("at") + 1, F.col("content")).alias("chunk_id"),
        "doc_key",
        "source_file",
        "source_type",
        "page",
        language(F.col("source_file"), F.col("content"), "通用编程").alias("language"),
        F.coalesce(F.get("domains", F.lit(0)), F.lit(UNPLACED)).alias("chapter"),
        section(F.col("title"), F.col("keywords")).alias("section"),
        "content",
        normal_terms(F.col("content")).alias("normalized_content"),
        "keywords",
        "domains",
        role(F.col("content"), F.col("source_type")).alias("material_role"),
        evidence_location(F.col("page"), F.col("question_id")).alias("evidence_location"),
        confidence_hint(F.size("domains"), F.col("content")).alias("confidence_hint"),
    )
