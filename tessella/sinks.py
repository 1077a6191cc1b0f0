"""Writers: property flattening, graph-database scripts, code-example export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.coerce import distinct_texts, safe_float, text


def quoted(value: Column) -> Column:
    """A string literal of a script, escaped as JSON."""
    return F.regexp_extract(F.to_json(F.struct(F.coalesce(value, F.lit("")).alias("v"))), r'^\{"v":(.*)\}$', 1)


def quoted_list(values: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(values, quoted), ", "), F.lit("]"))


def identifier(value: Column) -> Column:
    """A label or relation name: letters, digits and underscores only."""
    return F.regexp_replace(text(value), r"[^A-Za-z0-9_]", "_")


def source_values(sources: Column, field: str) -> Column:
    """Distinct non-empty values of a provenance field, in order."""
    return distinct_texts(F.transform(sources, lambda s: s[field].cast("string")))


def flat_nodes(rows: DataFrame) -> DataFrame:
    """Node rows with simple properties only: files and pages as lists, sources as JSON."""
    return rows.select("row_id", F.trim("id").alias("id"), F.coalesce("name", F.lit("")).alias("name"), "type", safe_float(F.col("confidence"), 0.0).alias("confidence"), source_values(F.col("sources"), "source_file").alias("source_files"), source_values(F.col("sources"), "page").alias("source_pages"), F.to_json(F.coalesce("sources", F.array())).alias("sources_json"))


def node_statements(nodes: DataFrame, aliases: DataFrame) -> DataFrame:
    """One idempotent script statement per node; ``aliases`` is (id, alias), each pair once.

    A statement holds all aliases of its node, so it is as long as they are.
    """
    listed = aliases.groupBy("id").agg(F.array_sort(F.collect_list("alias")).alias("aliases"))
    nodes = nodes.join(listed, "id", "left").withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))
    head = F.concat(F.lit("MERGE (n:KnowledgeNode:"), identifier(F.col("type")), F.lit(" {id: "), quoted(F.col("id")), F.lit("})\nSET n += {"))
    body = F.concat(F.lit("name: "), quoted(F.col("name")), F.lit(", type: "), quoted(F.col("type")), F.lit(", aliases: "), quoted_list(F.col("aliases")), F.lit("};"))
    return nodes.select("id", F.concat(head, body).alias("statement"))


def edge_statements(edges: DataFrame) -> DataFrame:
    """One idempotent script statement per edge."""
    match = lambda side: F.concat(F.lit(f"MATCH ({side}:KnowledgeNode {{id: "), quoted(F.col(side)), F.lit("})\n"))
    merge = F.concat(F.lit("MERGE (source)-[r:"), F.upper(identifier(F.col("type"))), F.lit(" {id: "), quoted(F.col("id")), F.lit("}]->(target);"))
    return edges.select("id", F.concat(match("source"), match("target"), merge).alias("statement"))


def graph_script(nodes: DataFrame, edges: DataFrame, aliases: DataFrame, wipe: bool = False) -> DataFrame:
    """(step, id, statement): the whole import: a constraint, an optional wipe, nodes, edges; each may be run again."""
    first = ["CREATE CONSTRAINT knowledge_node_id IF NOT EXISTS FOR (n:KnowledgeNode) REQUIRE n.id IS UNIQUE;"] + ["MATCH (n:KnowledgeNode) DETACH DELETE n;"] * wipe
    head = nodes.sparkSession.createDataFrame([(i, "", s) for i, s in enumerate(first)], "step int, id string, statement string")
    part = lambda df, step: df.select(F.lit(step).alias("step"), "id", "statement")
    return head.unionByName(part(node_statements(nodes, aliases), 2)).unionByName(part(edge_statements(edges), 3))


def localized_edge_statements(edges: DataFrame, names: dict[str, str]) -> DataFrame:
    """One statement per edge whose relation bears its shown name, with code and name as properties; names with other letters are quoted."""
    shown = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in names.items() for x in kv)), F.col("type")), F.col("type"))
    quoted_name = F.concat(F.lit("`"), F.replace(shown, F.lit("`"), F.lit("")), F.lit("`"))
    match = lambda side: F.concat(F.lit(f"MATCH ({side}:KnowledgeNode {{id: "), quoted(F.col(side)), F.lit("})\n"))
    tail = F.concat(F.lit("MERGE (source)-[r:"), quoted_name, F.lit(" {id: "), quoted(F.col("id")), F.lit("}]->(target)\nSET r.relation_code = "), quoted(F.col("type")), F.lit(", r.relation_name = "), quoted(shown), F.lit(";"))
    return edges.select("id", F.concat(match("source"), match("target"), tail).alias("statement"))


def question_statements(questions: DataFrame, links: DataFrame) -> DataFrame:
    """(step, id, statement): constraints, question nodes, links to type, difficulty and abilities, links to knowledge."""
    kinds = ("Question", "QuestionType", "Difficulty", "QuestionAbility")
    head = questions.sparkSession.createDataFrame([(0, k, f"CREATE CONSTRAINT {k.lower()}_id IF NOT EXISTS FOR (n:{k}) REQUIRE n.id IS UNIQUE;") for k in kinds], "step int, id string, statement string")
    own = questions.select(F.lit(1).alias("step"), F.col("question_id").alias("id"), F.concat(F.lit("MERGE (q:Question {id: "), quoted(F.col("question_id")), F.lit("})\nSET q.stem = "), quoted(F.col("stem")), F.lit(";")).alias("statement"))
    label = F.when(F.col("relation") == "HAS_TYPE", "QuestionType").when(F.col("relation") == "HAS_DIFFICULTY", "Difficulty").otherwise("QuestionAbility")
    ends = question_edges(questions).select(F.lit(2).alias("step"), F.col("question_id").alias("id"), F.concat(F.lit("MATCH (q:Question {id: "), quoted(F.col("question_id")), F.lit("})\nMERGE (x:"), label, F.lit(" {id: "), quoted(F.col("value")), F.lit("})\nMERGE (q)-[:"), F.col("relation"), F.lit("]->(x);")).alias("statement"))
    name = F.concat(F.lit("question_link_"), "question_id", F.lit("_"), "id")
    asks = links.select(F.lit(3).alias("step"), name.alias("id"), F.concat(F.lit("MATCH (q:Question {id: "), quoted(F.col("question_id")), F.lit("})\nMATCH (k:KnowledgeNode {id: "), quoted(F.col("id")), F.lit("})\nMERGE (q)-[r:ASSESSES {id: "), quoted(name), F.lit("}]->(k)\nSET r.role = "), quoted(F.col("role")), F.lit(";")).alias("statement"))
    return head.unionByName(own).unionByName(ends).unionByName(asks)


def write_records(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Rows as JSON lines, in order of ``order`` if given, swapped in when complete; nulls are written too."""
    rows = df.orderBy(*order) if order else df
    write_swapped(rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")), path, "text")


def question_edges(questions: DataFrame) -> DataFrame:
    """(question_id, relation, value): type, difficulty and abilities of each question as links."""
    one = lambda relation, value: F.array(F.struct(F.lit(relation).alias("relation"), value.cast("string").alias("value")))
    many = F.transform("abilities", lambda a: F.struct(F.lit("REQUIRES_ABILITY").alias("relation"), a.alias("value")))
    return questions.select("question_id", F.inline(F.concat(one("HAS_TYPE", F.col("type")), one("HAS_DIFFICULTY", F.col("difficulty")), many)))


def write_swapped(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Writes beside the target and renames, so that readers see the old table or the new one."""
    spark = df.sparkSession
    new, old = f"{path}.new", f"{path}.old"
    df.write.mode("overwrite").format(kind).save(new)
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = lambda p: hadoop.Path(p)
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(at(old), True)
    if fs.exists(at(path)):
        fs.rename(at(path), at(old))
    fs.rename(at(new), at(path))
    fs.delete(at(old), True)
