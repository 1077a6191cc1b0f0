"""Readers: folders of materials, exercise JSON, chunk and graph JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.coerce import first_text, text
from tessella.operators.cleaning import guess_title
from tessella.sources.office import read_office


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Whole text and Markdown files of a folder tree, sorted out by suffix; undecodable bytes are replaced."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.{txt,md}")
    name = F.col("_metadata.file_name")
    return files.select(name.alias("source_file"), F.regexp_extract(name, r"\.([^.]+)$", 1).alias("source_type"), F.make_valid_utf8("value").alias("raw_text"))


def read_exercises(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Exercises of JSON files: a list, or an object with ``questions``; each becomes one text.

    Fields have alternative names; options may be a list or an object.
    """
    schema = "id string, question_id string, question string, stem string, options variant, answer string, analysis string, explanation string"
    whole = spark.read.text(path, wholetext=True, recursiveFileLookup=recursive, pathGlobFilter="*.json" if recursive else None).select("value", F.col("_metadata.file_name").alias("source_file"))
    record = f"struct<{', '.join(c.replace(' ', ':') for c in schema.split(', '))}>"
    listed = F.when(F.rlike("value", F.lit(r"^\s*\{")), F.from_json("value", f"struct<questions:array<{record}>>")["questions"]).otherwise(F.from_json("value", f"array<{record}>"))
    rows = whole.select("source_file", F.posexplode(listed).alias("at", "q"))
    options = F.when(F.schema_of_variant("q.options").startswith("ARRAY"), F.try_variant_get("q.options", "$", "array<string>"))
    named = F.transform(F.map_entries(F.try_variant_get("q.options", "$", "map<string,string>")), lambda e: F.concat(e["key"], F.lit(". "), e["value"]))
    stem, analysis = first_text(F.col("q.question"), F.col("q.stem")), first_text(F.col("q.analysis"), F.col("q.explanation"))
    line = lambda label, value: F.when(value != "", F.concat(F.lit(label), value))
    body = F.concat_ws("\n", line("题干：", stem), F.array_join(F.coalesce(options, named), "\n"), line("答案：", text(F.col("q.answer"))), line("解析：", analysis))
    return rows.select(first_text(F.col("q.id"), F.col("q.question_id"), (F.col("at") + 1).cast("string")).alias("question_id"), "source_file", F.lit("exercise").alias("source_type"), body.alias("raw_text")).where("raw_text <> ''")


def read_graph(spark: SparkSession, path: str, nodes: str, edges: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of a graph JSON file, with their order; DDL schemas are given."""
    raw = spark.read.schema(f"nodes array<struct<{nodes}>>, edges array<struct<{edges}>>").json(path, multiLine=True)
    take = lambda c: raw.select(F.posexplode(c).alias("ord", "r")).select("ord", "r.*")
    return take("nodes"), take("edges")


def read_folder(spark: SparkSession, folder: str) -> DataFrame:
    """(source_file, source_type, page, question_id, title, raw_text): everything readable in a folder tree, by suffix.

    Text and Markdown whole, slides and document blocks one by one, exercise
    JSON question by question; the rows are a set, their order is that of
    ``source_file`` and ``page`` where one is needed.
    """
    columns = ["source_file", "source_type", "page", "question_id", "raw_text"]
    none = lambda kind: F.lit(None).cast(kind)
    texts = read_texts(spark, folder).withColumn("page", none("int")).withColumn("question_id", none("string")).select(*columns)
    office = read_office(spark, folder).where("raw_text IS NOT NULL").withColumn("question_id", none("string")).select(*columns)
    exercises = read_exercises(spark, folder, recursive=True).withColumn("page", none("int")).select(*columns)
    return texts.unionByName(office).unionByName(exercises).withColumn("title", guess_title(F.col("raw_text")))


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def first_existing(spark: SparkSession, candidates: list[str | None]) -> str:
    """The first path that is there (given ones before defaults); the first of all if none is."""
    given = [c for c in candidates if c]
    return next((c for c in given if path_exists(spark, c)), given[0])


def read_listed(spark: SparkSession, paths: list[str], key: str, schema: str) -> DataFrame:
    """Records of the first path that exists: a JSON list, or an object that holds one under ``key``; anything else is an error."""
    path = first_existing(spark, paths)
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    whole = spark.read.text(path, wholetext=True)
    record = f"array<struct<{schema}>>"
    found = F.when(F.rlike("value", F.lit(r"^\s*\[")), F.from_json("value", record)).otherwise(F.from_json("value", f"struct<`{key}`:{record}>")[key])
    checked = whole.select(F.coalesce(found, F.raise_error(F.lit(f"{path}: neither a list nor an object with {key}")).cast(record)).alias("r"))
    return checked.select(F.posexplode("r").alias("ord", "r")).select("ord", "r.*")


def read_chunks(spark: SparkSession, path: str, schema: str, limit: int = 0) -> DataFrame:
    """Chunks of a JSON list in their order; ``limit`` keeps the first ones, 0 keeps all."""
    rows = read_listed(spark, [path], "chunks", schema)
    return rows.orderBy("ord").limit(limit) if limit > 0 else rows


def read_graph_or_empty(spark: SparkSession, path: str, nodes: str, edges: str) -> tuple[DataFrame, DataFrame]:
    """As ``read_graph``, but a missing file is an empty graph."""
    if path_exists(spark, path):
        return read_graph(spark, path, nodes, edges)
    empty = lambda schema: spark.createDataFrame([], f"ord int, {schema}")
    return empty(nodes), empty(edges)


def read_links(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Question links: a JSON list, or an object with ``mappings``, ``links`` or ``items``."""
    whole = spark.read.text(path, wholetext=True)
    record = f"array<struct<{schema}>>"
    inside = F.from_json("value", f"struct<mappings:{record},links:{record},items:{record}>")
    found = F.when(F.rlike("value", F.lit(r"^\s*\[")), F.from_json("value", record)).otherwise(F.coalesce(inside["mappings"], inside["links"], inside["items"]))
    return whole.select(F.posexplode(found).alias("ord", "r")).select("ord", "r.*")


def read_code_examples(spark: SparkSession, path: str) -> DataFrame:
    """(id, local_id, title, code, language): examples with an id and code; of one id the last counts."""
    rows = read_listed(spark, [path], "examples", "id:string,local_id:string,title:string,code:string,language:string").where("id <> '' AND code IS NOT NULL")
    return rows.groupBy("id").agg(F.max_by(F.struct("local_id", "title", "code", "language"), "ord").alias("e")).select("id", "e.*")


def original_question(examples: DataFrame, stored: DataFrame) -> DataFrame:
    """(id, text, stored): the stored code of an example by its id or local id, else the joined contents of its sources.

    ``examples`` is (id, local_id, sources).
    """
    contents = F.filter(F.transform(F.coalesce("sources", F.array()), lambda s: text(s["content"])), lambda c: c != "")
    by = lambda key, name: stored.select(F.col(key).alias(f"_{name}"), F.col("code").alias(name)).where(F.col(f"_{name}").isNotNull()).dropDuplicates([f"_{name}"])
    rows = examples.join(by("id", "own"), F.col("id") == F.col("_own"), "left").join(by("local_id", "local"), F.col("local_id") == F.col("_local"), "left")
    return rows.select("id", F.coalesce("own", "local", F.array_join(contents, "\n\n")).alias("text"), F.coalesce("own", "local").isNotNull().alias("stored"))
