"""Column functions on text, all evaluated inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What counts as outer blank besides the space.
OUTER_BLANKS = " \t\r\n　"


def code_points(text: Column) -> Column:
    """Length in Unicode code points; null stays null."""
    return F.char_length(text)


def strip_blanks(text: Column) -> Column:
    """Without leading and trailing white space of any script."""
    return F.regexp_replace(text, r"(?U)^[\s　﻿]+|[\s　﻿]+$", "")


def is_blank(text: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return F.coalesce(F.length(strip_blanks(text)) == 0, F.lit(True))


def squeeze(text: Column) -> Column:
    """Lower case without space, tab, CR, LF and U+3000; null becomes empty."""
    return F.translate(F.lower(F.coalesce(text, F.lit(""))), OUTER_BLANKS, "")


def fixed(df: DataFrame, **columns: Column) -> DataFrame:
    """The columns added so that each is computed once a row, however often later steps use it.

    A projection may be merged into what uses it and then be computed for each
    use; a generator of one row is not.
    """
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))
