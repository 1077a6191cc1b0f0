"""Rule extraction of entities and relations from chunks, and their merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.coerce import adjusted_confidence, hash_id, round4, short_evidence
from tessella.functions.text import fixed
from tessella.vocabulary import CONCEPTS, ENTITY_TERMS, EXTRACTED_SCHEMA, EXTRACTED_TYPES, FORCED_TYPES, SYNTAX, SYNTAX_CONCEPTS

#: Fixed value: what makes a text look like code.
CODE = r"\b(class|interface|extends|implements|public|private|protected|void|new)\b|[{};]"
#: Patterns of code structures.
CLASS = r"\bclass\s+([A-Za-z_]\w*)"
INTERFACE = r"\binterface\s+([A-Za-z_]\w*)"
METHOD = r"\b(?:public|private|protected)?\s*(?:static\s+)?(?:void|int|String|boolean|double|float|char)\s+([A-Za-z_]\w*)\s*\("
EXTENDS = r"\bclass\s+([A-Za-z_]\w*)\s+extends\s+([A-Za-z_]\w*)"
IMPLEMENTS = r"\bclass\s+([A-Za-z_]\w*)\s+implements\s+([A-Za-z_]\w*)"
#: Languages that are no language.
NO_LANGUAGE = ("通用OOP", "通用编程", "未识别", "")
PARADIGM = "面向对象编程"


def found(content: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(F.coalesce(content, F.lit("")), F.lit(pattern), F.lit(group))


def looks_like_code(content: Column) -> Column:
    return F.rlike(F.coalesce(content, F.lit("")), F.lit(CODE))


def concepts_in(content: Column, terms=tuple(CONCEPTS)) -> Column:
    """Concept words in the text after term normalisation, shortest first."""
    ordered = sorted(set(terms), key=lambda t: (len(t), t))
    return F.array_compact(F.array(*(F.when(F.contains(content, F.lit(t)), F.lit(t)) for t in ordered)))


def syntax_in(content: Column, words=tuple(SYNTAX)) -> Column:
    """Keywords of the syntax that stand as whole words in the text, in any case."""
    low = F.lower(F.coalesce(content, F.lit("")))
    ordered = sorted(set(words), key=lambda t: (len(t), t))
    return F.array_compact(F.array(*(F.when(F.rlike(low, F.lit(rf"(?U)\b{t}\b")), F.lit(t)) for t in ordered)))


def structures(chunks: DataFrame) -> DataFrame:
    """(chunk_id, name, kind): classes, interfaces and methods that the code declares, each mention a row."""
    content = F.col("content")

    def declared(kind: str, pattern: str) -> Column:
        return F.transform(found(content, pattern), lambda x: F.struct(x.alias("name"), F.lit(kind).alias("kind")))

    each = [declared("class", CLASS), declared("interface", INTERFACE), declared("method", METHOD)]
    return chunks.select("chunk_id", F.explode(F.concat(*each)).alias("s")).select("chunk_id", "s.name", "s.kind")


def structure_links(chunks: DataFrame) -> DataFrame:
    """(chunk_id, head, relation, tail): what classes extend and implement."""
    content = F.col("content")

    def pairs(pattern: str, relation: str) -> Column:
        return F.transform(F.arrays_zip(found(content, pattern, 1).alias("head"), found(content, pattern, 2).alias("tail")), lambda p: F.struct(p["head"].alias("head"), F.lit(relation).alias("relation"), p["tail"].alias("tail")))

    return chunks.select("chunk_id", F.inline(F.concat(pairs(EXTENDS, "inherits_from"), pairs(IMPLEMENTS, "implements_interface"))))


def _read(chunks: DataFrame) -> DataFrame:
    """Chunks with what the rules see in each: concepts, keywords, language, example, declared structures and their links."""
    normal = F.coalesce(F.col("content"), F.lit(""))
    for old, new in ENTITY_TERMS:
        normal = F.regexp_replace(normal, f"(?iu)\\Q{old}\\E", new)
    example = F.coalesce(F.col("material_role") == "code_example", F.lit(False)) | looks_like_code(F.col("content"))
    language = F.coalesce(F.col("language"), F.lit(""))
    pair = lambda p: F.arrays_zip(found(F.col("content"), p, 1).alias("name"), found(F.col("content"), p, 0).alias("evidence"))
    link = lambda p, r: F.transform(F.arrays_zip(found(F.col("content"), p, 1).alias("h"), found(F.col("content"), p, 2).alias("t"), found(F.col("content"), p, 0).alias("e")), lambda x: F.struct(x["h"].alias("head"), F.lit(r).alias("relation"), x["t"].alias("tail"), x["e"].alias("evidence")))
    rows = fixed(chunks, _normal=normal)
    return fixed(
        rows,
        _concepts=concepts_in(F.col("_normal")),
        _syntax=syntax_in(F.col("content")),
        _language=F.when(~language.isin(*NO_LANGUAGE), language),
        _example=F.when(example, F.concat(F.lit("CodeExample_"), F.col("chunk_id"))),
        _declared=F.concat(pair(CLASS), pair(INTERFACE), pair(METHOD)),
        _links=F.concat(link(EXTENDS, "inherits_from"), link(IMPLEMENTS, "implements_interface")),
    )


_EXPRESSED = [x for kv in SYNTAX_CONCEPTS.items() for x in kv]


def rule_entities(chunks: DataFrame) -> DataFrame:
    """(chunk_id, content, name, type, confidence, evidence) that the rules find in each chunk.

    Gives the paradigm of every chunk, its language, its concepts, keywords
    and the concepts these express, a code example where it looks like one
    with the structures it declares, and both ends of links between structures.
    """
    entity = lambda n, t, c, e: F.struct(n.alias("name"), F.lit(t).alias("type"), F.lit(c).alias("confidence"), e.alias("evidence"))
    none = F.array().cast("array<struct<name:string,type:string,confidence:double,evidence:string>>")
    expressed = F.create_map(*(F.lit(x) for x in _EXPRESSED))
    known = F.filter("_syntax", lambda x: F.try_element_at(expressed, x).isNotNull())
    parts = [
        F.array(entity(F.lit(PARADIGM), "ProgrammingParadigm", 0.95, F.lit("面向对象"))),
        F.when(F.col("_language").isNotNull(), F.array(entity(F.col("_language"), "ProgrammingLanguage", 0.9, F.col("_language")))).otherwise(none),
        F.transform("_concepts", lambda x: entity(x, "OOPConcept", 0.82, x)),
        F.transform("_syntax", lambda x: entity(x, "SyntaxRule", 0.86, x)),
        F.transform(known, lambda x: entity(F.try_element_at(expressed, x), "OOPConcept", 0.8, F.try_element_at(expressed, x))),
        F.when(F.col("_example").isNotNull(), F.concat(F.array(entity(F.col("_example"), "CodeExample", 0.9, short_evidence(F.col("content")))), F.transform("_declared", lambda d: entity(d["name"], "CodeStructure", 0.86, d["evidence"])))).otherwise(none),
        F.flatten(F.transform("_links", lambda k: F.array(entity(k["head"], "CodeStructure", 0.86, k["evidence"]), entity(k["tail"], "CodeStructure", 0.86, k["evidence"])))),
    ]
    return _read(chunks).select("chunk_id", "content", F.inline(F.concat(*parts)))


def rule_relations(chunks: DataFrame) -> DataFrame:
    """(chunk_id, content, head, head_type, relation, tail, tail_type, confidence, evidence) that the rules find in each chunk."""
    none = F.array().cast("array<struct<head:string,head_type:string,relation:string,tail:string,tail_type:string,confidence:double,evidence:string>>")
    expressed = F.create_map(*(F.lit(x) for x in _EXPRESSED))

    def one(head: Column, head_type: str, relation: Column | str, tail: Column, tail_type: str, confidence: float, evidence: Column) -> Column:
        named = F.lit(relation) if isinstance(relation, str) else relation
        return F.struct(head.alias("head"), F.lit(head_type).alias("head_type"), named.alias("relation"), tail.alias("tail"), F.lit(tail_type).alias("tail_type"), F.lit(confidence).alias("confidence"), evidence.alias("evidence"))

    paradigm, language, example = F.lit(PARADIGM), F.col("_language"), F.col("_example")
    told, shows = language.isNotNull(), example.isNotNull()
    known = F.filter("_syntax", lambda x: F.try_element_at(expressed, x).isNotNull())
    parts = [
        F.transform("_concepts", lambda x: one(x, "OOPConcept", "belongs_to_paradigm", paradigm, "ProgrammingParadigm", 0.88, x)),
        F.when(told, F.transform("_concepts", lambda x: one(x, "OOPConcept", "implemented_in", language, "ProgrammingLanguage", 0.72, language))).otherwise(none),
        F.when(told, F.transform("_syntax", lambda x: one(x, "SyntaxRule", "implemented_in", language, "ProgrammingLanguage", 0.8, x))).otherwise(none),
        F.transform(known, lambda x: one(F.try_element_at(expressed, x), "OOPConcept", "has_syntax", x, "SyntaxRule", 0.86, x)),
        F.transform(known, lambda x: one(x, "SyntaxRule", "expresses_concept", F.try_element_at(expressed, x), "OOPConcept", 0.86, x)),
        F.when(shows, F.transform("_concepts", lambda x: one(example, "CodeExample", "demonstrates", x, "OOPConcept", 0.82, x))).otherwise(none),
        F.when(shows, F.transform("_syntax", lambda x: one(example, "CodeExample", "uses_syntax", x, "SyntaxRule", 0.84, x))).otherwise(none),
        F.when(shows, F.transform("_declared", lambda d: one(example, "CodeExample", "contains_structure", d["name"], "CodeStructure", 0.86, d["evidence"]))).otherwise(none),
        F.transform("_links", lambda k: one(k["head"], "CodeStructure", k["relation"], k["tail"], "CodeStructure", 0.88, k["evidence"])),
    ]
    return _read(chunks).select("chunk_id", "content", F.inline(F.concat(*parts)))


def entity_name(name: Column) -> Column:
    """The name of an extracted entity: single blanks, and one spelling where the whole name is a known term."""
    bare = F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r"(?U)\s+", " "))
    table = F.create_map(*(F.lit(x) for old, new in ENTITY_TERMS for x in (old.lower(), new)))
    return F.coalesce(F.try_element_at(table, F.lower(bare)), bare)


def entity_type(name: Column, kind: Column) -> Column:
    """The type that the name forces, else as given."""
    table = F.create_map(*(F.lit(x) for kv in FORCED_TYPES.items() for x in kv))
    return F.coalesce(F.try_element_at(table, name), F.trim(F.coalesce(kind, F.lit(""))))


def checked_relations(relations: DataFrame, least: float = 0.6, schema=None) -> DataFrame:
    """Relations with names and types in order, put right, scored, and ``reason``: why they are left out, null if they aren't.

    Reasons, first one counts: schema_invalid (no name, or no such relation),
    endpoint_type_invalid, low_confidence, schema_mismatch (types not allowed).
    """
    schema = schema or EXTRACTED_SCHEMA
    rest = [c for c in relations.columns if c not in ("head", "tail", "head_type", "tail_type")]
    named = fixed(relations.select(*rest, F.col("head_type").alias("_ht"), F.col("tail_type").alias("_tt"), F.col("head").alias("_h"), F.col("tail").alias("_t")), head=entity_name(F.col("_h")), tail=entity_name(F.col("_t")))
    typed = fixed(named, head_type=entity_type(F.col("head"), F.col("_ht")), tail_type=entity_type(F.col("tail"), F.col("_tt"))).drop("_h", "_t", "_ht", "_tt")
    rows = fixed(repaired(typed), score=adjusted_confidence(F.col("confidence"), F.col("evidence"), F.col("content"), 0.7))
    triples = [f"{r}|{h}|{t}" for r, (heads, tails) in schema.items() for h in heads for t in tails]
    allowed = F.concat_ws("|", "relation", "head_type", "tail_type").isin(*triples)
    reason = (
        F.when((F.col("head") == "") | (F.col("tail") == "") | ~F.col("relation").isin(*schema), "schema_invalid")
        .when(~F.col("head_type").isin(*EXTRACTED_TYPES) | ~F.col("tail_type").isin(*EXTRACTED_TYPES), "endpoint_type_invalid")
        .when(F.col("score") < least, "low_confidence")
        .when(~allowed, "schema_mismatch")
    )
    return rows.withColumn("reason", reason)


def merged_relations(relations: DataFrame, least: float = 0.6) -> DataFrame:
    """(id, head, head_type, relation, tail, tail_type, confidence, evidence, chunks): valid relations, each once.

    Of one (head, relation, tail): the greatest score, the longest evidence, the number of chunks.
    """
    rows = checked_relations(relations, least).where("reason IS NULL")
    longest = F.struct(F.char_length("evidence"), F.col("evidence"))
    merged = rows.groupBy("head", "head_type", "relation", "tail", "tail_type").agg(F.max("score").alias("confidence"), F.max_by("evidence", longest).alias("evidence"), F.countDistinct("chunk_id").alias("chunks"))
    return merged.withColumn("id", hash_id("rel", F.col("head"), F.col("relation"), F.col("tail")))


def completed_entities(entities: DataFrame, relations: DataFrame, least: float = 0.55) -> DataFrame:
    """(name, type, confidence): ends of merged relations that no merged entity stands for, a little less sure than their relation."""
    ends = F.array(F.struct(F.col("head").alias("name"), F.col("head_type").alias("type")), F.struct(F.col("tail").alias("name"), F.col("tail_type").alias("type")))
    each = relations.select(F.inline(ends), "confidence")
    new = each.join(entities.select("name", "type"), ["name", "type"], "left_anti")
    return new.groupBy("name", "type").agg(F.greatest(F.lit(least), F.max("confidence") - 0.05).alias("confidence"))


def scored_entities(rows: DataFrame) -> DataFrame:
    """Entities with their adjusted confidence as ``score``."""
    return fixed(rows, score=adjusted_confidence(F.col("confidence"), F.col("evidence"), F.col("content"), 0.72))


def merged_entities(rows: DataFrame, least: float = 0.55) -> DataFrame:
    """Entities by (name, type): greatest adjusted confidence and number of chunks; those below ``least`` are left out."""
    scored = scored_entities(rows).where(F.col("score") >= least)
    return scored.groupBy("name", "type").agg(F.max("score").alias("confidence"), F.countDistinct("chunk_id").alias("chunks")).withColumn("id", hash_id("ent", F.col("type"), F.col("name")))


def merge_mentions(mentions: DataFrame) -> DataFrame:
    """Entity mentions by (name, type): greatest sound confidence, longest description, chunks and sources.

    Mentions delivered twice count once.  Aggregation only, with partials, so
    that a name with a tenth of all mentions is no hot spot; distinct chunks
    and sources are counted through their own aggregation.
    """
    rows = mentions.where("name IS NOT NULL")
    sound = F.when((F.col("confidence") > 0) & (F.col("confidence") <= 1), F.col("confidence"))
    longest = F.struct(F.char_length("description"), F.negative(F.col("mention_id")))
    main = rows.groupBy("name", "type").agg(
        F.countDistinct("mention_id").alias("mentions"),
        round4(F.coalesce(F.max(sound), F.lit(0.0))).alias("confidence"),
        F.max_by("description", F.when(F.col("description").isNotNull(), longest)).alias("description"),
    )
    chunks = rows.select("name", "type", F.explode("source_chunk_ids").alias("c")).distinct().groupBy("name", "type").agg(F.count("c").alias("chunks"))
    keyed = rows.select("name", "type", F.explode("sources").alias("s")).select("name", "type", F.struct("s.chunk_id", "s.source_file", "s.page").alias("s"))
    sources = keyed.distinct().groupBy("name", "type").agg(F.count("*").alias("sources"))
    same = lambda d: (F.col("m.name") == F.col(f"{d}.name")) & F.col("m.type").eqNullSafe(F.col(f"{d}.type"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return main.alias("m").join(chunks.alias("c"), same("c"), "left").join(sources.alias("s"), same("s"), "left").select("m.name", "m.type", "m.mentions", "m.confidence", "m.description", zero("c.chunks").alias("chunks"), zero("s.sources").alias("sources"))


def repaired(relations: DataFrame) -> DataFrame:
    """Relations whose kind or direction contradicts their types, put right; columns head, head_type, relation, tail, tail_type."""
    r, h, t = F.col("relation"), F.col("head_type"), F.col("tail_type")
    fix = lambda kind, turn: F.struct(F.lit(kind).alias("relation"), F.lit(turn).alias("turn"))
    rule = (
        F.when((r == "part_of") & (h == "OOPConcept") & (t == "ProgrammingParadigm"), fix("belongs_to_paradigm", False))
        .when((r == "part_of") & (h == "OOPConcept") & (t == "ProgrammingLanguage"), fix("implemented_in", False))
        .when((r == "belongs_to_paradigm") & (h == "ProgrammingParadigm") & (t == "OOPConcept"), fix("belongs_to_paradigm", True))
        .when((r == "belongs_to_paradigm") & (h == "ProgrammingLanguage") & (t == "ProgrammingParadigm"), fix("implemented_in", True))
        .when((r == "has_code_structure") & (h == "OOPConcept") & (t == "OOPConcept"), fix("part_of", True))
        .when((r == "has_syntax") & (h == "SyntaxRule") & (t == "OOPConcept"), fix("has_syntax", True))
        .when((r == "expresses_concept") & (h == "OOPConcept") & (t == "OOPConcept"), fix("part_of", False))
    )
    turned = F.coalesce(F.col("_fix.turn"), F.lit(False))
    rows = fixed(relations, _fix=rule)
    swap = lambda a, b: F.when(turned, F.col(b)).otherwise(F.col(a))
    return rows.select(
        *(c for c in relations.columns if c not in ("head", "head_type", "relation", "tail", "tail_type")),
        swap("head", "tail").alias("head"),
        swap("head_type", "tail_type").alias("head_type"),
        F.coalesce("_fix.relation", "relation").alias("relation"),
        swap("tail", "head").alias("tail"),
        swap("tail_type", "head_type").alias("tail_type"),
    )
