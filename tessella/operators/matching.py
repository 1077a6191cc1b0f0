"""Joins by containment: which texts contain which phrases, without comparing all with all."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.runtime import Scratch

#: Phrases, and characters in them, that are sent to every task at most; more are joined by a shuffle.
SENT, SENT_LENGTH = 100_000, 5_000_000


def containing(texts: DataFrame, key: str, text: str, phrases: DataFrame, phrase: str, gram: int = 4) -> DataFrame:
    """(key, phrase): each text with each distinct phrase it contains, exactly and case as given.

    The phrases are written and counted first.  A bounded list is made into an
    automaton that every task passes its texts through once: nothing but the
    hits leaves the task.  A longer list is joined on the first ``gram``
    characters of the phrases with the substrings of the texts, and the hits
    are compared in full.  Both give the same rows.  Nulls and empty texts and
    phrases give nothing; repeated keys count once.
    """
    spark = texts.sparkSession
    scratch = Scratch(spark, "containing")
    wanted = phrases.select(F.col(phrase).cast("string").alias("phrase")).where("phrase <> ''").distinct()
    wanted = scratch.write(wanted.withColumn("n", F.char_length("phrase")), "phrases")
    body = texts.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where("text <> ''")
    size = wanted.agg(F.count("*").alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("letters")).first()
    if size.rows <= SENT and size.letters <= SENT_LENGTH:
        shared = spark.sparkContext.broadcast([r.phrase for r in wanted.select("phrase").collect()])
        found = body.mapInArrow(lambda it: _search(it, shared), f"key {body.schema['key'].dataType.simpleString()}, phrase string")
    else:
        found = _joined(body, wanted, gram)
    return found.select(F.col("key").alias(key), "phrase").distinct()


def _search(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    automaton = None
    for batch in batches:
        if automaton is None:
            automaton = ahocorasick.Automaton()
            for p in shared.value:
                automaton.add_word(p, p)
            automaton.make_automaton()
        at, hits = [], []
        for i, text in enumerate(batch.column(1).to_pylist() if len(automaton) else ()):
            for p in {p for _, p in automaton.iter(text)}:
                at.append(i)
                hits.append(p)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(hits, pa.string())], names=["key", "phrase"])


def _joined(body: DataFrame, wanted: DataFrame, gram: int) -> DataFrame:
    # Phrases shorter than a head are their own head.
    heads_of = wanted.select("phrase", F.substring("phrase", 1, gram).alias("head"))
    lengths = range(1, gram + 1)
    # A lookahead matches at every position, so one pass over the text gives all substrings of a length.
    substrings = F.concat(*(F.regexp_extract_all("text", F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in lengths))
    heads = body.select("key", F.explode(F.array_distinct(substrings)).alias("head"))
    near = heads.join(heads_of, "head").select("key", "phrase").distinct()
    return near.join(body, "key").where(F.contains("text", F.col("phrase"))).select("key", "phrase")
