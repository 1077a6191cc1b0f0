"""Decisions of a model or a reviewer as tables: which are asked for, which are accepted, what they change.

The clients that make decisions are outside the engine; a decision is a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessella.functions.coerce import safe_float, text
from tessella.vocabulary import NODE_TYPES, RELATION_SCHEMA


def chunk_needs_model(has_semantic_entity: Column, hint: Column, least: float = 0.75) -> Column:
    """Whether rules are not enough for a chunk: nothing semantic found, or the chunk itself is unsure."""
    return ~F.coalesce(has_semantic_entity, F.lit(False)) | (safe_float(hint, 0.0) < least)


def questions_needing_model(candidates: DataFrame, top: float = 5.0, lead: float = 2.0) -> DataFrame:
    """(question_id, needed): a model decides unless the best of two candidates is strong and leads clearly."""
    best = F.max(F.when(F.col("place") == 1, F.col("score")))
    second = F.max(F.when(F.col("place") == 2, F.col("score")))
    rows = candidates.where("place <= 2").groupBy("question_id").agg(best.alias("a"), second.alias("b"))
    return rows.select("question_id", (F.col("b").isNotNull() & ~((F.col("a") >= top) & (F.col("a") - F.col("b") >= lead))).alias("needed"))


def accepted_merge(should_merge: Column, confidence: Column, canonical_type: Column, least: float = 0.85) -> Column:
    """Whether a merge decision counts: it says so, surely enough, and names a known type."""
    return F.coalesce(should_merge, F.lit(False)) & (safe_float(confidence, 0.0) >= least) & F.coalesce(text(canonical_type).isin(*NODE_TYPES), F.lit(False))


def reviewed_relations(relations: DataFrame, decisions: DataFrame, least: float = 0.75, schema=None) -> DataFrame:
    """Relations with ``new_type``, ``new_confidence`` and ``reason`` after review; a reason means it stays uncertain.

    ``relations`` has id, source_type, type, target_type; ``decisions`` id,
    action, relation_type, confidence (the last row of an id by ``ord``).
    Relations without a decision stay as they are.
    """
    schema = schema or RELATION_SCHEMA
    last = decisions.groupBy("id").agg(F.max_by(F.struct("action", "relation_type", "confidence"), "ord").alias("d"))
    kind = F.lower(text(F.coalesce("d.relation_type", "type")))
    triples = [f"{r}|{h}|{t}" for r, (heads, tails) in schema.items() for h in heads for t in tails]
    reason = (
        F.when(F.col("d").isNull(), F.lit(None).cast("string"))
        .when(~F.coalesce(F.lower(text(F.col("d.action"))), F.lit("")).isin("keep", "repair"), "action")
        .when(safe_float(F.col("d.confidence"), 0.0) < least, "confidence")
        .when(~F.coalesce(F.concat_ws("|", kind, "source_type", "target_type"), F.lit("")).isin(*triples), "type")
    )
    rows = relations.join(last, "id", "left").withColumn("reason", reason)
    used = F.col("d").isNotNull() & F.col("reason").isNull()
    return rows.withColumn("new_type", F.when(used, kind).otherwise(F.col("type"))).withColumn("new_confidence", F.when(used, safe_float(F.col("d.confidence"), 0.0)).otherwise(F.col("confidence"))).drop("d")


def model_links(answers: DataFrame, candidates: DataFrame, rules: DataFrame, most: int = 5) -> DataFrame:
    """(question_id, name, id, role, confidence, place): a model's links where any holds, else those of the rules.

    ``answers`` is (question_id, at, name, role, confidence) in the model's
    order.  Only candidates of the question count, each once, the first
    ``most``; an unknown role is secondary, a missing confidence 0.6.
    """
    first = answers.withColumn("name", text(F.col("name"))).groupBy("question_id", "name").agg(F.min_by(F.struct("role", "confidence"), "at").alias("a"), F.min("at").alias("at"))
    known = first.join(candidates.select("question_id", "name", "id"), ["question_id", "name"])
    order = Window.partitionBy("question_id").orderBy("at", "name")
    kept = known.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    role = F.when(text(F.col("a.role")) == "primary", "primary").otherwise("secondary")
    own = kept.select("question_id", "name", "id", role.alias("role"), safe_float(F.col("a.confidence"), 0.6).alias("confidence"), "place")
    rest = rules.join(own.select("question_id").distinct(), "question_id", "left_anti").select("question_id", "name", "id", "role", "confidence", "place")
    return own.unionByName(rest)


def approved(answer_source: Column, answer: Column, status: Column, confidence: Column, least: float = 0.85) -> Column:
    """Whether a question may be used: a given answer, or a generated one that was verified surely enough."""
    has = text(answer) != ""
    made = (answer_source == "llm_generated") & (status == "verified") & (safe_float(confidence, 0.0) >= least)
    return F.coalesce(has & ((answer_source == "provided") | made), F.lit(False))


def completed_answers(questions: DataFrame, generated: DataFrame, verified: DataFrame, least: float = 0.85) -> DataFrame:
    """(question_id, answer, analysis, answer_source, answer_kind, answer_status, answer_confidence).

    Questions with an answer keep it.  Others take the verifier's answer or
    else the generated one; it is as sure as the less sure of the two, and
    verified only if accepted, not empty and at least ``least`` sure.
    """
    g = generated.select("question_id", F.struct("answer_kind", "answer", "analysis", "confidence").alias("g"))
    v = verified.select("question_id", F.struct("accepted", "answer", "analysis", "confidence").alias("v"))
    rows = questions.select("question_id", text(F.col("answer")).alias("own"), text(F.col("analysis")).alias("why")).join(g, "question_id", "left").join(v, "question_id", "left")
    pick = lambda f: F.when(text(F.col(f"v.{f}")) != "", text(F.col(f"v.{f}"))).otherwise(text(F.col(f"g.{f}")))
    sure = F.least(safe_float(F.col("g.confidence"), 0.0), safe_float(F.col("v.confidence"), 0.0))
    given = F.col("own") != ""
    good = F.coalesce(F.col("v.accepted"), F.lit(False)) & (pick("answer") != "") & (sure >= least)
    return rows.select(
        "question_id",
        F.when(given, F.col("own")).otherwise(pick("answer")).alias("answer"),
        F.when(given, F.col("why")).otherwise(pick("analysis")).alias("analysis"),
        F.when(given, "provided").when(F.col("g").isNull(), "missing").otherwise("llm_generated").alias("answer_source"),
        F.when(given | (F.col("g.answer_kind") == "standard_answer"), "standard_answer").when(F.col("g").isNull(), "unknown").otherwise("reference_solution").alias("answer_kind"),
        F.when(given | good, "verified").when(F.col("g").isNull(), "needs_generation").otherwise("needs_review").alias("answer_status"),
        F.when(given, 1.0).otherwise(F.bround(sure, 4)).alias("answer_confidence"),
    )


def within_budget(groups: DataFrame, order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows in order: what a budget of decisions is spent on."""
    return groups.orderBy(*order).limit(most)
