"""Structured Streaming forms of the ingest operators.

The batch operators are stateless column functions, so a stream runs them as
they are; what needs state is dropping rows delivered twice and counting by
time, both bounded by a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.operators.cleaning import clean_text, matched_keywords, relevance
from tessella.runtime import Scratch


def once(stream: DataFrame, key: str, at: str, delay: str = "21 days") -> DataFrame:
    """Rows of a stream without those whose key came before, within the watermark's delay."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def cleaned(stream: DataFrame) -> DataFrame:
    """Cleaned texts with their score and keywords, row by row, without state."""
    rows = stream.withColumn("cleaned", clean_text(F.col("raw_text"))).where("cleaned <> ''")
    return rows.withColumn("score", relevance(F.col("cleaned"))).withColumn("keywords", matched_keywords(F.col("cleaned")))


def arrivals(stream: DataFrame, at: str, by: str, window: str = "1 day", delay: str = "21 days") -> DataFrame:
    """(start, by, n): rows per time window and group; late rows count until the watermark passes."""
    counted = stream.withWatermark(at, delay).groupBy(F.window(at, window), by).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("start"), by, "n")


def upsert(batch: DataFrame, path: str, key: str, at: str, buckets: int = 64) -> None:
    """For foreachBatch: the table at ``path`` with the latest row of each key; a repeated batch changes nothing.

    The table is laid out in ``buckets`` partitions by the key's hash, and a
    batch rewrites only those that its keys fall into.  What replaces them is
    written to scratch first, so nothing is read from what is being replaced.
    """
    spark = batch.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    rows = batch.withColumn("bucket", F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int"))
    touched = [r.bucket for r in rows.select("bucket").distinct().collect()]
    if not touched:
        return
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        rows = spark.read.parquet(path).where(F.col("bucket").isin(touched)).unionByName(rows)
    names = [c for c in rows.columns if c != "bucket"]
    newest = rows.groupBy("bucket", key).agg(F.max_by(F.struct(*names), F.struct(at, F.xxhash64(*names))).alias("r")).select("r.*", "bucket")
    ready = Scratch(spark, "upsert").write(newest, "rows")
    ready.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
