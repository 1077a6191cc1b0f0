"""Exercises from office documents: blocks, questions, their kind, code and difficulty.

A document is its paragraphs in order; everything is a fold over that array,
row by row in the JVM, without a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a question starts; sections; sections with answers, which hold no questions.
QUESTION_START = (
    r"(?i)^(?:\d+[.、．]|Given\b|Define(?!\s+(?:a\s+)?(?:derived|another)\b)\b|Please\b|Write\b|Implement\b|In the following\b|According to\b|A stack\b|Important aspects\b"
    r"|选择|打开文件|假设|对下面|阅读下面|用C\+\+|已知类|下表中)"
)
SECTION_START = r"^第[一二三四五六七八九十\d]+篇"
ANSWER_SECTION = r"(?i)^第3篇|常见错误"
#: Words one of which a question holds; what makes a line look like code, and what opens a stretch of code.
QUESTION_MARKERS = ("class", "struct", "program", "代码", "函数", "输出", "定义", "实现", "错误", "队列", "栈", "继承", "template")
CODE_HINT = r"(^#include\b|[{};]|\b(class|struct|template|namespace|void|int|double|char|bool|public|private|protected|virtual|return|cout|cin|main)\b|//)"
CODE_LINE = (
    r"^(?:#include\b|(?:class|struct)\s+[A-Za-z_]\w*.*[{:]|(?:public|private|protected)\s*:"
    r"|(?:void|int|double|float|char|bool|auto|[A-Za-z_]\w*\s*[*&]?)\s+[A-Za-z_]\w*\s*\([^)]*\)\s*\{?|[{}]|//)"
)
#: What tells the kind and the difficulty, in this order.
FIXING = ("错误所在", "改正", "改错", "error")
READING = ("输出", "write the output", "which type-conversions")
PROGRAMMING = ("define", "implement", "实现", "定义", "design")
HARD = ("template", "虚函数", "多重", "类型转换", "class hierarchy")
#: Abilities that a kind of question asks for.
ABILITIES = {"code_fixing": ("错误定位", "代码修正"), "code_reading": ("代码阅读", "运行结果分析"), "short_programming": ("程序设计", "代码实现")}


def has_any(content: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(content, F.lit(w)) for w in words])


def question_like(lines: Column) -> Column:
    """At least 30 characters, a sign of a question (its first line's start, or a question mark), and one of the markers.

    Texts that only refer to another file are none.
    """
    whole = F.lower(F.array_join(lines, "\n"))
    starts = F.coalesce(F.rlike(F.get(lines, F.lit(0)), F.lit(QUESTION_START)), F.lit(False))
    return (F.char_length(whole) >= 30) & (starts | has_any(whole, ("?", "？"))) & has_any(whole, QUESTION_MARKERS) & ~whole.startswith("打开文件")


def question_blocks(paragraphs: Column) -> Column:
    """array<struct<section, first, last, lines>>: the question-like blocks of a document's paragraphs.

    A section starts a new block and names those after it; answer sections are
    passed over, as is what stands before the first section.  In a section a
    block ends where a paragraph starts like a question.
    """
    block = "struct<section:string,first:int,last:int,lines:array<string>>"
    start = F.struct(
        F.array().cast(f"array<{block}>").alias("done"),
        F.array().cast("array<string>").alias("lines"),
        F.lit("").alias("section"),
        F.lit(False).alias("open"),
        F.lit(1).alias("first"),
        F.lit(0).alias("at"),
    )

    def closed(acc: Column) -> Column:
        own = F.struct(acc["section"].alias("section"), acc["first"].alias("first"), acc["at"].alias("last"), acc["lines"].alias("lines"))
        return F.when(F.size(acc["lines"]) > 0, F.array_append(acc["done"], own)).otherwise(acc["done"])

    def step(acc: Column, line: Column) -> Column:
        none, here = F.array().cast("array<string>"), acc["at"] + 1
        section = F.rlike(line, F.lit(SECTION_START))
        begins = ~section & acc["open"] & F.rlike(line, F.lit(QUESTION_START)) & (F.size(acc["lines"]) > 0)
        fresh = begins | (F.size(acc["lines"]) == 0)
        return F.struct(
            F.when(section | begins, closed(acc)).otherwise(acc["done"]).alias("done"),
            F.when(section, none).when(~acc["open"], acc["lines"]).when(begins, F.array(line)).otherwise(F.array_append(acc["lines"], line)).alias("lines"),
            F.when(section, line).otherwise(acc["section"]).alias("section"),
            F.when(section, ~F.rlike(line, F.lit(ANSWER_SECTION))).otherwise(acc["open"]).alias("open"),
            F.when(section | (acc["open"] & fresh), here).otherwise(acc["first"]).alias("first"),
            here.alias("at"),
        )

    found = F.aggregate(paragraphs, start, step, lambda acc: F.when(acc["open"], closed(acc)).otherwise(acc["done"]))
    return F.filter(found, lambda b: question_like(b["lines"]))


def question_kind(lines: Column) -> Column:
    """code_fixing, code_reading or short_programming by the words of the text, else by whether a line looks like code."""
    whole = F.lower(F.array_join(lines, "\n"))
    code = F.exists(lines, lambda x: F.rlike(x, F.lit(CODE_HINT)))
    return F.when(has_any(whole, FIXING), "code_fixing").when(has_any(whole, READING), "code_reading").when(has_any(whole, PROGRAMMING), "short_programming").when(code, "code_reading").otherwise("short_programming")


def stem_and_code(lines: Column) -> Column:
    """struct<stem, code>: whole lines of code, and indented or bare brace lines after the first of them, are code; the rest is the stem."""
    start = F.struct(F.array().cast("array<string>").alias("stem"), F.array().cast("array<string>").alias("code"), F.lit(False).alias("on"))

    def step(acc: Column, line: Column) -> Column:
        is_code = F.rlike(F.trim(line), F.lit(CODE_LINE))
        on = acc["on"] | is_code
        takes = on & (is_code | line.startswith(" ") | line.startswith("\t") | line.isin("{", "}"))
        return F.struct(F.when(takes, acc["stem"]).otherwise(F.array_append(acc["stem"], line)).alias("stem"), F.when(takes, F.array_append(acc["code"], line)).otherwise(acc["code"]).alias("code"), on.alias("on"))

    def finish(acc: Column) -> Column:
        bare = lambda c: F.regexp_replace(F.array_join(acc[c], "\n"), r"(?U)^\s+|\s+$", "")
        return F.struct(F.when(bare("stem") == "", F.coalesce(F.get(lines, F.lit(0)), F.lit(""))).otherwise(bare("stem")).alias("stem"), bare("code").alias("code"))

    return F.aggregate(lines, start, step, finish)


def difficulty(lines: Column) -> Column:
    return F.when(has_any(F.lower(F.array_join(lines, "\n")), HARD), 4).otherwise(3)


def abilities(kind: Column) -> Column:
    out = F.array(*(F.lit(a) for a in ABILITIES["short_programming"]))
    for name in ("code_fixing", "code_reading"):
        out = F.when(kind == name, F.array(*(F.lit(a) for a in ABILITIES[name]))).otherwise(out)
    return out


def document_questions(documents: DataFrame, key: str, paragraphs: Column, cells: Column, prefix: str = "CPP_DOCX_", least_cell: int = 20) -> DataFrame:
    """(key, question_id, kind, stem, code, difficulty, abilities, section, first, last): the questions of each document.

    Blocks of paragraphs first, then every table cell of ``least_cell``
    characters or more as a piece of code to put right; ids are numbered
    through the document.
    """
    none = F.array().cast("array<string>")
    text_part = F.transform(question_blocks(F.coalesce(paragraphs, none)), lambda b: F.struct(b["lines"].alias("lines"), b["section"].alias("section"), b["first"].alias("first"), b["last"].alias("last"), F.lit(False).alias("cell")))
    kept = F.filter(F.transform(F.coalesce(cells, none), lambda c, i: F.struct(F.array(c).alias("lines"), F.lit("").alias("section"), (i + 1).alias("first"), (i + 1).alias("last"), F.lit(True).alias("cell"))), lambda c: F.char_length(c["lines"][0]) >= least_cell)
    rows = documents.select(F.col(key), F.posexplode(F.concat(text_part, kept)).alias("at", "b")).select(key, "at", "b.*")
    split = rows.withColumn("kind", F.when(F.col("cell"), "code_fixing").otherwise(question_kind(F.col("lines")))).withColumn("parts", stem_and_code(F.col("lines")))
    return split.select(
        key,
        F.format_string(f"{prefix}%03d", F.col("at") + 1).alias("question_id"),
        "kind",
        F.when(F.col("cell"), "指出下面代码片段中的错误，并说明原因。").otherwise(F.col("parts.stem")).alias("stem"),
        F.when(F.col("cell"), F.col("lines")[0]).otherwise(F.col("parts.code")).alias("code"),
        F.when(F.col("cell"), 3).otherwise(difficulty(F.col("lines"))).alias("difficulty"),
        abilities(F.col("kind")).alias("abilities"),
        "section",
        "first",
        "last",
    )
