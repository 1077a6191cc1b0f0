"""Reports and audits: integrity of graph and mapping, before and after, release checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.coerce import first_text, text
from tessella.operators.graph import integrity, schema_check, with_endpoints
from tessella.operators.hierarchy import resolve_roots
from tessella.operators.views import cyclic_part


def _beside(parts: list[DataFrame]) -> DataFrame:
    """One-row frames side by side."""
    return reduce(lambda a, b: a.crossJoin(b), parts)


def mapping_integrity(links: DataFrame, questions: DataFrame, nodes: DataFrame, aliases: DataFrame) -> DataFrame:
    """One row of counters over links (question_id, knowledge_id, knowledge_name).

    A link whose id is no node's may still be resolved by the node's name or
    an alias, in any case; else it is unresolved.
    """
    ids = nodes.select(F.lower("id").alias("low")).distinct()
    names = ids.unionByName(nodes.select(F.lower(text(F.col("name"))).alias("low"))).unionByName(aliases.select(F.lower(text(F.col("alias"))).alias("low"))).where("low <> ''").distinct()
    low = lambda c: F.lower(text(F.col(c)))
    rows = links.select(low("knowledge_id").alias("kid"), low("knowledge_name").alias("name"))
    by_id = rows.join(ids.select(F.col("low").alias("kid"), F.lit(True).alias("known")), "kid", "left")
    by_name = by_id.join(names.select(F.col("low").alias("name"), F.lit(True).alias("named")), "name", "left")
    bad = F.col("known").isNull()
    counts = by_name.agg(F.count("*").alias("links"), F.count_if(bad).alias("invalid_node_ids"), F.count_if(bad & F.col("named").isNotNull()).alias("fallback_name_matches"), F.count_if(bad & F.col("named").isNull()).alias("unresolved_links"))
    mapped = links.select("question_id").where("question_id <> ''").distinct()
    own = questions.select("question_id").where("question_id <> ''").distinct()
    unknown = mapped.join(own, "question_id", "left_anti").agg(F.count("*").alias("invalid_question_ids"))
    without = own.join(mapped, "question_id", "left_anti").agg(F.count("*").alias("questions_without_mapping"))
    return _beside([counts, unknown, without, mapped.agg(F.count("*").alias("question_links"))])


def health(nodes: DataFrame, edges: DataFrame, questions: DataFrame, links: DataFrame, aliases: DataFrame) -> DataFrame:
    """One row: the sizes of graph, questions and mapping, and all counters of their integrity."""
    return _beside([integrity(nodes, edges), questions.agg(F.count("*").alias("questions")), mapping_integrity(links, questions, nodes, aliases)])


def distribution(rows: DataFrame, stage: str, kind: str, value: Column) -> DataFrame:
    """(stage, kind, value, n) without empty values."""
    return rows.select(value.alias("value")).where("value <> ''").groupBy("value").agg(F.count("*").alias("n")).select(F.lit(stage).alias("stage"), F.lit(kind).alias("kind"), "value", "n")


def before_after(raw_nodes: DataFrame, raw_edges: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(stage, kind, value, n): sizes and types before and after merging."""
    parts = []
    for stage, n, e in (("before", raw_nodes, raw_edges), ("after", nodes, edges)):
        for kind, rows in (("node", n), ("edge", e)):
            parts.append(distribution(rows, stage, kind, F.col("type")))
            parts.append(rows.agg(F.count("*").alias("n")).select(F.lit(stage).alias("stage"), F.lit(kind).alias("kind"), F.lit("*").alias("value"), "n"))
    return reduce(DataFrame.unionByName, parts)


def hierarchy_check(edges: DataFrame) -> DataFrame:
    """One row: part_of edges, children without exactly one parent, nodes from which going up (by the least parent) never ends."""
    part = edges.where("type = 'part_of'")
    parents = part.groupBy(F.col("source").alias("id")).agg(F.count("*").alias("n"), F.min("target").alias("parent_id"))
    time = F.lit(None).cast("timestamp")
    up = resolve_roots(parents.select("id", "parent_id", time.alias("updated_at"), time.alias("ingested_at")))
    return _beside([part.agg(F.count("*").alias("hierarchy_edges")), parents.agg(F.count_if(F.col("n") != 1).alias("invalid_parents")), up.agg(F.count_if(F.col("cycle_id").isNotNull()).alias("in_cycles"))])


def example_language(sources: Column) -> Column:
    """The language that file names and contents of an example's sources speak of."""
    words = F.lower(F.array_join(F.transform(F.coalesce(sources, F.array()), lambda s: F.concat_ws(" ", F.coalesce(s["source_file"], F.lit("")), F.coalesce(s["content"], F.lit("")))), " "))
    has = lambda *ws: reduce(lambda a, b: a | b, [F.contains(words, F.lit(w)) for w in ws])
    return F.when(has("java", "system.out", "public class"), "Java").when(has("python", "def ", "print("), "Python").when(has("c++", "#include", "std::", "cout"), "C++").otherwise("通用编程")


def exported_examples(rows: DataFrame) -> DataFrame:
    """(row_id, id, title, code, language, complete): code examples with the distinct contents of their sources as code."""
    parts = F.filter(F.transform(F.coalesce("sources", F.array()), lambda s: text(s["content"])), lambda c: c != "")
    code = F.array_join(F.array_distinct(parts), "\n\n")
    picked = rows.where("type = 'CodeExample'").select("row_id", F.coalesce("id", F.lit("")).alias("id"), F.coalesce("name", F.lit("")).alias("title"), code.alias("code"), example_language(F.col("sources")).alias("language"))
    return picked.withColumn("complete", (F.col("title") != "") & (F.col("code") != ""))


def require_complete(examples: DataFrame) -> DataFrame:
    """The examples, or an error when one that lacks a title or its code is read."""
    checked = F.assert_true("complete", "a code example lacks a title or its code")
    return examples.where(checked.isNull())


def release_audit(nodes: DataFrame, edges: DataFrame, raw_edges: DataFrame, questions: DataFrame, links: DataFrame, aliases: DataFrame, examples: DataFrame, roots: tuple[str, ...] = ("Course", "KnowledgeDomain")) -> DataFrame:
    """(check, violations): the named checks of a release; a check passes if nothing violates it.

    ``nodes`` are rows before merging by id, so that repeated ids show.
    """
    one = lambda name, df: df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")
    repeated = lambda df, *keys: df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    ids = nodes.groupBy("id").agg(F.min("type").alias("type"), F.min("name").alias("name"))
    ends = with_endpoints(edges, ids.select("id", "type"))
    dangling = ends.where("source_type IS NULL OR target_type IS NULL")
    joined = edges.select(F.explode(F.array("source", "target")).alias("id")).distinct()
    owners = aliases.select("id", F.lower(text(F.col("alias"))).alias("low")).where("low <> ''").distinct()
    other = ids.select(F.col("id").alias("owner"), F.lower(text(F.col("name"))).alias("low")).where("low <> ''")
    languages = ends.where("type = 'implemented_in'")
    structures = ids.where("type = 'CodeStructure'").select("id")
    scoped = ends.where("type = 'appears_in_example' AND target_type = 'CodeExample'").select(F.col("source").alias("id"))
    known = F.lower(text(F.col("knowledge_name")))
    named = ids.select(F.lower(text(F.col("name"))).alias("low")).unionByName(owners.select("low")).distinct()
    per_question = links.where("role = 'primary'").groupBy("question_id").agg(F.count("*").alias("n"))
    rooted = ids.where(F.col("type").isin(*roots)).select("id")
    checks = [
        one("unique_node_ids", repeated(nodes, "id")),
        one("unique_question_ids", repeated(questions, "question_id")),
        one("unique_mapping_ids", repeated(links, "question_id", "knowledge_name")),
        one("question_mapping_coverage", questions.select("question_id").join(links.select("question_id"), "question_id", "left_anti")),
        one("no_dangling_edges", dangling),
        one("no_self_loops", edges.where("source = target")),
        one("no_duplicate_edges", repeated(raw_edges, "source", "type", "target")),
        one("formal_schema_valid", schema_check(edges, ids.select("id", "type")).where("NOT valid")),
        one("nodes_connected", ids.select("id").join(joined, "id", "left_anti").join(rooted, "id", "left_anti")),
        one("prerequisite_dag_valid", cyclic_part(edges.where("type = 'prerequisite_of'"))),
        one("language_scope_valid", languages.where("target_type IS NULL OR target_type <> 'ProgrammingLanguage'")),
        one("language_facts_valid", ends.where("type = 'differs_from' AND source_type = 'ProgrammingLanguage' AND (target_type IS NULL OR target_type <> 'ProgrammingLanguage')")),
        one("aliases_valid", owners.join(other, "low").where("id <> owner").select("low").distinct()),
        one("code_examples_valid", examples.where("NOT complete")),
        one("code_structures_scoped", structures.join(scoped, "id", "left_anti")),
        one("example_leaves", ends.where("source_type = 'CodeExample'")),
        one("formal_answers_present", questions.where("answer = ''")),
        one("mapping_references_valid", links.select(known.alias("low")).join(named, "low", "left_anti")),
        one("mapping_policy_valid", per_question.where("n > 2")),
    ]
    return reduce(DataFrame.unionByName, checks)


def format_counts(nodes: DataFrame, edges: DataFrame, triples: DataFrame, statements: DataFrame) -> DataFrame:
    """(format, nodes, edges): what each form of the graph says of its size; they are to be equal."""
    count = lambda df, name: df.agg(F.count("*").alias(name))
    json = _beside([count(nodes, "nodes"), count(edges, "edges")]).select(F.lit("json").alias("format"), "nodes", "edges")
    rdf = triples.agg(F.count_if(F.col("predicate") == "type").alias("nodes"), F.count_if(~F.col("object").startswith('"')).alias("edges")).select(F.lit("rdf").alias("format"), "nodes", "edges")
    script = statements.agg(F.count_if(F.col("statement").startswith("MERGE")).alias("nodes"), F.count_if(F.col("statement").startswith("MATCH")).alias("edges")).select(F.lit("script").alias("format"), "nodes", "edges")
    return json.unionByName(rdf).unionByName(script)


def search(nodes: DataFrame, questions: DataFrame, word: str, limit: int = 12) -> DataFrame:
    """(place, kind, id, type): nodes that mention a word in table order, then questions, until the limit is filled."""
    low = word.strip().lower()
    hay = lambda *cs: F.lower(F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in cs)))
    n = nodes.where(F.contains(hay(F.col("id"), first_text(F.col("name"), F.col("id")), F.col("type"), text(F.col("description"))), F.lit(low))).select(F.lit(0).alias("rank"), "ord", F.lit("knowledge").alias("kind"), "id", "type")
    q = questions.where(F.contains(hay(F.col("question_id"), F.col("stem"), F.col("analysis"), F.array_join("abilities", " ")), F.lit(low))).select(F.lit(1).alias("rank"), F.lit(0).cast("bigint").alias("ord"), F.lit("question").alias("kind"), F.col("question_id").alias("id"), "type")
    both = n.unionByName(q) if low else n.unionByName(q).limit(0)
    return both.orderBy("rank", "ord", "id").limit(max(1, limit)).select("kind", "id", "type")
