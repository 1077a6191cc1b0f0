"""Cleaning, filtering and labelling of material texts, as JVM expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.coerce import text
from tessella.functions.text import fixed
from tessella.vocabulary import BACKGROUND, KEYWORDS, ROLES, STRONG_KEYWORDS, TERMS, WEAK_KEYWORDS

#: Lines that carry no content, compared after stripping.
NOISE_LINE = r"(?i)^(\d+|第\s*\d+\s*页|page\s*\d+|目录|contents?|thank\s+you|谢谢观看|参考文献|references?)$"
#: Shapes of object-oriented code.
CODE_SHAPE = r"(?i)\b(class|interface|extends|implements)\s+[A-Za-z_]\w*|\babstract\s+class\b|\b(this|super)\."
#: Fixed value: how a line starts that opens a new block.
BULLET = r"^([\-*•]|\d+[.)、]|[A-D][.)、])"
LINE_END = "\r\n|[\n\r\u0085  \u000b\u000c\u001c\u001d\u001e]"


def lines_of(content: Column) -> Column:
    """Stripped lines with single blanks; control characters and U+3000 are cleaned first."""
    plain = F.regexp_replace(F.translate(F.coalesce(content, F.lit("")), "　", " "), "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]", "")
    return F.transform(F.split(plain, LINE_END), lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " ")))


def is_noise_line(line: Column) -> Column:
    return F.rlike(line, F.lit(NOISE_LINE))


def clean_text(content: Column) -> Column:
    """The text without empty and noise lines; null becomes empty."""
    return F.array_join(F.filter(lines_of(content), lambda x: (x != "") & ~is_noise_line(x)), "\n")


def guess_title(content: Column, length: int = 60) -> Column:
    """The first line that is not blank, cut to ``length``; empty if there is none."""
    found = F.filter(F.transform(F.split(F.coalesce(content, F.lit("")), LINE_END), lambda x: F.regexp_replace(x, r"(?U)^[\s　]+|[\s　]+$", "")), lambda x: x != "")
    return F.coalesce(F.substring(F.get(found, F.lit(0)), 1, length), F.lit(""))


def hits(content: Column, words) -> Column:
    """How many of the words occur in the text, in any case."""
    low = F.lower(F.coalesce(content, F.lit("")))
    return reduce(lambda a, b: a + b, [F.contains(low, F.lit(w.lower())).cast("int") for w in words], F.lit(0))


def matched_keywords(content: Column, words=tuple(KEYWORDS)) -> Column:
    """The words that occur in the text, shortest first, then by code point."""
    low = F.lower(F.coalesce(content, F.lit("")))
    found = [F.when(F.contains(low, F.lit(w.lower())), F.lit(w)) for w in sorted(words, key=lambda w: (len(w), w))]
    return F.array_compact(F.array(*found))


def relevance(content: Column) -> Column:
    """Three for a strong word, one for a weak one (three at most), two for code, minus five for background."""
    score = hits(content, STRONG_KEYWORDS) * 3 + F.least(hits(content, WEAK_KEYWORDS), F.lit(3))
    code = F.rlike(F.coalesce(content, F.lit("")), F.lit(CODE_SHAPE)).cast("int") * 2
    return score + code - (hits(content, BACKGROUND) > 0).cast("int") * 5


def language(source_file: Column, content: Column, default: str = "通用OOP") -> Column:
    low = F.lower(F.concat_ws("\n", F.coalesce(source_file, F.lit("")), F.coalesce(content, F.lit(""))))
    has = lambda *ws: reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in ws])
    return F.when(has("java", "extends", "implements"), "Java").when(has("python", "__init__", "self."), "Python").when(has("c++", "virtual", "::"), "C++").otherwise(default)


def role(content: Column, source_type: Column) -> Column:
    """The role with the most words in the text; ties by the order of the roles, none means explanation."""
    counts = {r: hits(content, ws) for r, ws in ROLES.items()}
    most = F.greatest(*counts.values())
    picked = F.lit("concept_explanation")
    for r in reversed(list(counts)):
        picked = F.when(counts[r] == most, r).otherwise(picked)
    return F.when(source_type == "exercise", "exercise").when(most == 0, "concept_explanation").otherwise(picked)


def chapter(title: Column, content: Column) -> Column:
    both = F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(content, F.lit("")))
    low = F.lower(both)
    has = lambda c, *ws: reduce(lambda a, b: a | b, [F.contains(c, F.lit(w)) for w in ws])
    name = lambda x: F.lit(f"面向对象编程-{x}")
    return (
        F.when(has(both, "继承", "extends"), name("继承"))
        .when(has(both, "多态") | has(low, "polymorphism"), name("多态"))
        .when(has(both, "接口") | has(low, "interface"), name("接口"))
        .when(has(both, "封装") | has(low, "private", "protected"), name("封装"))
        .when(has(both, "构造") | has(low, "constructor"), name("构造方法"))
        .when(has(both, "类", "对象") | has(low, "class"), name("类与对象"))
        .otherwise("面向对象编程")
    )


def section(title: Column, keywords: Column) -> Column:
    return F.when(F.coalesce(title, F.lit("")) != "", title).when(F.size(keywords) > 0, F.array_join(F.slice(keywords, 1, 3), "、")).otherwise("未标注小节")


def normal_terms(content: Column, terms=TERMS) -> Column:
    """Terms replaced one after the other in any case; a later one sees what earlier ones made."""
    out = content
    for old, new in terms:
        out = F.regexp_replace(out, f"(?iu)\\Q{old}\\E", new)
    return out


def confidence_hint(content: Column, keywords: Column) -> Column:
    marks = ["class", "extends", "implements", "接口", "继承", "多态", "封装"]
    marked = reduce(lambda a, b: a | b, [F.contains(content, F.lit(m)) for m in marks])
    hundredths = 55 + (F.size(keywords) >= 2).cast("int") * 15 + marked.cast("int") * 15 + (F.char_length(content) >= 25).cast("int") * 10
    return F.least(hundredths, F.lit(95)) / 100


def pack(pieces: Column, limit: int = 420) -> Column:
    """Pieces joined by a blank as long as they stay within the limit."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc: Column, piece: Column) -> Column:
        full = (F.char_length(acc["open"]) + F.char_length(piece) > limit) & (acc["open"] != "")
        joined = F.when(acc["open"] == "", piece).otherwise(F.concat(acc["open"], F.lit(" "), piece))
        return F.struct(F.when(full, F.array_append(acc["done"], acc["open"])).otherwise(acc["done"]).alias("done"), F.when(full, piece).otherwise(joined).alias("open"))

    return F.aggregate(F.filter(pieces, lambda p: p != ""), start, step, lambda acc: F.when(acc["open"] == "", acc["done"]).otherwise(F.array_append(acc["done"], acc["open"])))


def blocks(cleaned: Column) -> Column:
    """Lines joined by a blank, a new block at each bullet, number or option."""
    mark = F.transform(F.split(cleaned, "\n"), lambda x: F.when(F.rlike(x, F.lit(BULLET)), F.concat(F.lit("\u0001"), x)).otherwise(x))
    return F.filter(F.transform(F.split(F.array_join(F.filter(mark, lambda x: x != ""), " "), " ?\u0001"), lambda b: F.trim(b)), lambda b: b != "")


def chunk_texts(cleaned: Column, source_type: Column, limit: int = 420, least: int = 8) -> Column:
    """Chunks of a cleaned text: exercises whole, else blocks, long ones packed from their sentences."""
    short_enough = lambda b: F.char_length(b) <= limit
    cut = F.flatten(F.transform(blocks(cleaned), lambda b: F.when(short_enough(b), F.array(b)).otherwise(pack(F.split(b, r"(?<=[。！？.!?])\s+"), limit))))
    whole = F.array(cleaned)
    return F.filter(F.transform(F.when(source_type == "exercise", whole).otherwise(cut), lambda c: F.trim(c)), lambda c: F.char_length(c) >= least)


def chunk_id(source_file: Column, location: Column, index: Column, content: Column) -> Column:
    """Readable stem, location, number and the first digits of a digest."""
    stem = F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(source_file, r"\.[^.]*$", ""), r"[^a-zA-Z0-9]+", "_"), r"^_+|_+$", ""))
    digest = F.substring(F.md5(F.concat_ws("-", source_file, location, index.cast("string"), content).cast("binary")), 1, 8)
    return F.concat_ws("_", stem, location, index.cast("string"), digest)


def evidence_location(page: Column, question_id: Column) -> Column:
    asked = text(question_id)
    return F.when(page.isNotNull(), F.concat(F.lit("第"), page.cast("string"), F.lit("页"))).when(asked != "", F.concat(F.lit("第"), asked, F.lit("题"))).otherwise("全文")


def preprocess(raw: DataFrame, page_score: int = 3, chunk_score: int = 3) -> DataFrame:
    """Raw texts to labelled chunks: clean, filter pages, cut, filter chunks, label.

    Rows delivered twice count once (by doc_key).  One plan, no shuffle but
    that of the deduplication, no Python.
    """
    read = fixed(raw.select("doc_key", "source_file", "source_type", "page", "question_id", "title", "raw_text"), cleaned=clean_text(F.col("raw_text")))
    # Only pages that stay are shuffled, and only their cleaned text.
    cleaned = read.where((F.col("cleaned") != "") & (relevance(F.col("cleaned")) >= page_score)).drop("raw_text").dropDuplicates(["doc_key"])
    cut = cleaned.select("doc_key", "source_file", "source_type", "page", "question_id", "title", F.posexplode(chunk_texts(F.col("cleaned"), F.col("source_type"))).alias("at", "content"))
    kept = fixed(cut, keywords=matched_keywords(F.col("content"))).where((F.size("keywords") > 0) & (relevance(F.col("content")) >= F.when(F.col("source_type") == "exercise", 2).otherwise(chunk_score)))
    asked = text(F.col("question_id"))
    location = F.when(asked != "", asked).otherwise(F.coalesce(F.col("page").cast("string"), F.lit("doc")))
    return kept.select(
        chunk_id(F.col("source_file"), location, F.col("at") + 1, F.col("content")).alias("chunk_id"),
        "doc_key",
        "source_file",
        "source_type",
        "page",
        language(F.col("source_file"), F.col("content")).alias("language"),
        chapter(F.col("title"), F.col("content")).alias("chapter"),
        section(F.col("title"), F.col("keywords")).alias("section"),
        "content",
        normal_terms(F.col("content")).alias("normalized_content"),
        "keywords",
        role(F.col("content"), F.col("source_type")).alias("material_role"),
        evidence_location(F.col("page"), F.col("question_id")).alias("evidence_location"),
        confidence_hint(F.col("content"), F.col("keywords")).alias("confidence_hint"),
    )
