"""Catalog operators: alias index, text matches, enrichment of a graph by a curriculum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessella.functions.coerce import NAME_MARKS, wide_hash_id
from tessella.operators.matching import containing
from tessella.operators.resolution import compatibility_form

#: Node types whose place only the curriculum gives.
PLACED_TYPES = ("KnowledgeDomain", "KnowledgeUnit", "KnowledgePoint")


def catalog_key(value: Column) -> Column:
    """How names are compared: NFKC, lower case, without blanks and marks."""
    return F.regexp_replace(F.lower(compatibility_form(F.coalesce(value, F.lit("")))), NAME_MARKS, "")


def alias_index(catalog: DataFrame) -> DataFrame:
    """(key, id): the entry with the smallest id that has the key as name, alias or keyword."""
    values = F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")), F.coalesce("keywords", F.array().cast("array<string>")))
    rows = catalog.select("id", F.explode(values).alias("value")).where("id IS NOT NULL")
    return rows.select("id", catalog_key(F.col("value")).alias("key")).where("key <> ''").groupBy("key").agg(F.min("id").alias("id"))


def text_matches(texts: DataFrame, key: str, text: str, catalog: DataFrame, most: int = 12) -> DataFrame:
    """(key, id, length, place): entries whose longest key of two characters or more stands in a text; longest first."""
    index = alias_index(catalog).where(F.char_length("key") >= 2).select(F.col("key").alias("phrase"), "id")
    plain = texts.select(F.col(key), catalog_key(F.col(text)).alias("plain"))
    hits = containing(plain, key, "plain", index, "phrase").join(index, "phrase")
    best = hits.groupBy(key, "id").agg(F.max(F.char_length("phrase")).cast("bigint").alias("length"))
    order = Window.partitionBy(key).orderBy(F.desc("length"), "id")
    return best.withColumn("place", F.row_number().over(order).cast("bigint")).where(F.col("place") <= most)


def placed(nodes: DataFrame, catalog: DataFrame) -> DataFrame:
    """(id, new_id, catalog_id, candidate): where each node goes.

    Nodes named as an entry move to it; others of the placed types are only
    candidates; any other node stays.
    """
    index = alias_index(catalog).select(F.col("key").alias("k"), F.col("id").alias("catalog_id"))
    rows = nodes.select("id", "type", catalog_key(F.col("name")).alias("k")).join(index, "k", "left")
    candidate = F.col("catalog_id").isNull() & F.coalesce(F.col("type").isin(*PLACED_TYPES), F.lit(False))
    return rows.select("id", F.when(F.col("catalog_id").isNotNull(), F.concat(F.lit("curriculum_"), "catalog_id")).when(~candidate, F.col("id")).alias("new_id"), "catalog_id", candidate.alias("candidate"))


def enriched_nodes(nodes: DataFrame, catalog: DataFrame, ancestors: DataFrame) -> DataFrame:
    """(id, name, type, coverage, confidence): covered entries, the entries above them, and nodes that stay.

    ``ancestors`` is (id, ancestor) of the catalog, each entry with itself.
    """
    where = placed(nodes, catalog)
    direct = where.where("catalog_id IS NOT NULL").select(F.col("catalog_id").alias("id")).distinct()
    covered = ancestors.join(direct, "id", "left_semi").select(F.col("ancestor").alias("id")).distinct()
    entries = catalog.select("id", "name", "type").join(covered, "id").join(direct.withColumn("direct", F.lit(True)), "id", "left")
    shown = entries.select(F.concat(F.lit("curriculum_"), "id").alias("id"), "name", "type", F.when(F.col("direct"), "direct").otherwise("structural").alias("coverage"), F.when(F.col("direct"), 0.98).otherwise(0.9).alias("confidence"))
    kept = nodes.join(where.where("catalog_id IS NULL AND NOT candidate").select("id"), "id", "left_semi").select("id", "name", "type", F.lit("direct").alias("coverage"), "confidence")
    return shown.unionByName(kept)


def enriched_edges(edges: DataFrame, nodes: DataFrame, catalog: DataFrame, ancestors: DataFrame) -> DataFrame:
    """(id, source, type, target, confidence): edges moved to the entries, their hierarchy rebuilt from the catalog."""
    where = placed(nodes, catalog).where("new_id IS NOT NULL").select("id", "new_id")
    to = lambda c: where.select(F.col("id").alias(c), F.col("new_id").alias(f"new_{c}"))
    moved = edges.where("type <> 'part_of'").join(to("source"), "source").join(to("target"), "target")
    kept = moved.groupBy(F.col("new_source").alias("source"), "type", F.col("new_target").alias("target")).agg(F.max("confidence").alias("confidence"))
    covered = enriched_nodes(nodes, catalog, ancestors).select("id")
    parts = catalog.where("id <> 'ROOT'").select(F.concat(F.lit("curriculum_"), "id").alias("source"), F.lit("part_of").alias("type"), F.concat(F.lit("curriculum_"), "parent_id").alias("target"), F.lit(1.0).alias("confidence"))
    parts = parts.join(covered.withColumnRenamed("id", "source"), "source", "left_semi").join(covered.withColumnRenamed("id", "target"), "target", "left_semi")
    both = kept.unionByName(parts.select("source", "type", "target", "confidence"))
    return both.withColumn("id", wide_hash_id("edge", F.col("source"), F.col("type"), F.col("target")))
