"""Column functions that turn dirty values into typed ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text(value: Column) -> Column:
    """Stripped text; null becomes empty."""
    return F.coalesce(F.regexp_replace(value.cast("string"), r"(?U)^[\s　]+|[\s　]+$", ""), F.lit(""))


def first_text(*values: Column) -> Column:
    """The first of the values that is not blank, stripped; empty if none is."""
    out = F.lit("")
    for v in reversed(values):
        out = F.when(text(v) != "", text(v)).otherwise(out)
    return out


def safe_float(value: Column, default: float = 0.0) -> Column:
    """A double in [0, 1]; NaN counts as 0, null and what can't be read as the default."""
    number = value.try_cast("double")
    bounded = F.greatest(F.lit(0.0), F.least(number, F.lit(1.0)))
    return F.when(number.isNull(), F.lit(default)).when(F.isnan(number), F.lit(0.0)).otherwise(bounded)


def safe_int(value: Column, default: int) -> Column:
    return F.coalesce(value.try_cast("int"), F.lit(default))


def round4(value: Column) -> Column:
    """Half-even rounding to four decimals."""
    return F.bround(value, 4)


def adjusted_confidence(confidence: Column, evidence: Column, content: Column, default: float) -> Column:
    """Confidence raised where the evidence stands in the content, lowered without evidence.

    Zero, null and unreadable confidences take the default first.
    """
    number = confidence.try_cast("double")
    number = F.when(number.isNull() | (number == 0), F.lit(default)).otherwise(number)
    number = F.when(F.isnan(number), F.lit(0.0)).otherwise(number)
    score = F.greatest(F.lit(0.0), F.least(number, F.lit(1.0)))
    proof = text(evidence)
    score = score + F.when(proof == "", F.lit(-0.08)).when(F.contains(F.coalesce(content, F.lit("")), proof), F.lit(0.05)).otherwise(F.lit(0.0))
    return round4(F.greatest(F.lit(0.0), F.least(score, F.lit(0.98))))


def strength(confidence: Column, default: int = 64) -> Column:
    """Confidence as a whole number from 45 to 95; negative or unreadable gives the default."""
    number = confidence.try_cast("double")
    scaled = F.bround(F.when(number <= 1, number * 100).otherwise(number), 0).cast("int")
    bounded = F.greatest(F.lit(45), F.least(F.lit(95), scaled))
    return F.when(number.isNull() | F.isnan(number) | (number < 0), F.lit(default)).otherwise(bounded)


#: Fixed value: the characters that names are compared without.
NAME_MARKS = r"[\s_\-·.。,:：;；()（）\[\]【】{}<>《》/\\]+"


def fingerprint(name: Column) -> Column:
    """Lower-case name without blanks and marks."""
    return F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), NAME_MARKS, "")


def hash_id(prefix: str, *parts: Column, length: int = 12) -> Column:
    """Stable id: the prefix and the first digits of the parts' digest."""
    return F.concat(F.lit(prefix + "_"), F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, length))


def wide_hash_id(prefix: str, *parts: Column, length: int = 16) -> Column:
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(F.concat_ws(":", *parts).cast("binary"), 256), 1, length))


def short_evidence(content: Column, length: int = 120) -> Column:
    """One line of at most ``length`` characters."""
    return F.substring(text(F.regexp_replace(F.coalesce(content, F.lit("")), r"(?U)\s+", " ")), 1, length)


def distinct_texts(values: Column) -> Column:
    """Distinct non-blank members in their first order, stripped; null gives an empty array."""
    stripped = F.transform(values, lambda v: F.regexp_replace(v.cast("string"), r"(?U)^[\s　]+|[\s　]+$", ""))
    return F.coalesce(F.array_distinct(F.filter(stripped, lambda v: v.isNotNull() & (v != ""))), F.array().cast("array<string>"))
