"""Readers of office documents: slides and word-processing files are zipped XML, read with the standard library.

Files are read as binary by Spark, one row each, and parsed where they lie.
Scanned PDF and old binary slides need parsers of their own; their extracted
text enters by the text readers.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
#: Fixed value: a short paragraph that ends a block of a document.
HEADING = re.compile(r"^(第[一二三四五六七八九十\d]+[篇章节]|\d+[.、．])")
#: Paragraphs in a block at most, and how short a heading is.
BLOCK, SHORT = 12, 60
#: Folder of converted slides, which is not read again.
CONVERTED = "_converted_pptx"


def _slide_lines(root: ElementTree.Element) -> list[str]:
    """Shape texts, paragraph by paragraph, then table rows with their cells side by side."""
    out: list[str] = []
    for shape in root.iter(f"{P}sp"):
        lines = ["".join(t.text or "" for t in p.iter(f"{A}t")) for p in shape.iter(f"{A}p")]
        if any(x.strip() for x in lines):
            out.append("\n".join(lines))
    for row in root.iter(f"{A}tr"):
        cells = ["\n".join("".join(t.text or "" for t in p.iter(f"{A}t")) for p in c.iter(f"{A}p")).strip() for c in row.findall(f"{A}tc")]
        if any(cells):
            out.append(" | ".join(c for c in cells if c))
    return out


def slides(data: bytes) -> list[tuple[int, str]]:
    """(number, text) of every slide with a text, in the order of their file numbers."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = {int(m.group(1)): n for n in z.namelist() if (m := re.fullmatch(r"ppt/slides/slide(\d+)\.xml", n))}
        texts = [(i, "\n".join(_slide_lines(ElementTree.fromstring(z.read(names[i])))).strip()) for i in sorted(names)]
    return [(at, t) for at, (_, t) in enumerate(texts, 1) if t]


def paragraphs_and_cells(data: bytes) -> tuple[list[str], list[str]]:
    """The paragraphs of a document outside tables, and the table cells, stripped and without empty ones."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{W}body")
    said = lambda e: "".join((t.text or "") if t.tag == f"{W}t" else "\n" if t.tag == f"{W}br" else "\t" for t in e.iter() if t.tag in (f"{W}t", f"{W}br", f"{W}tab")).strip()
    if body is None:
        return [], []
    paragraphs = [said(p) for p in body.findall(f"{W}p")]
    cells = ["\n".join(said(p) for p in c.findall(f"{W}p")).strip() for c in body.iter(f"{W}tc")]
    return [p for p in paragraphs if p], [c for c in cells if c]


def blocks(paragraphs: list[str]) -> list[str]:
    """Paragraphs in blocks of twelve at most; a short heading ends its block."""
    out, held = [], []
    for p in paragraphs:
        held.append(p)
        if len(held) >= BLOCK or len(p) < SHORT and HEADING.match(p):
            out.append("\n".join(held))
            held = []
    return out + ["\n".join(held)] if held else out


def _files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    return files.where(~F.contains("path", F.lit(f"/{CONVERTED}/"))).select(F.element_at(F.split("path", "/"), -1).alias("source_file"), "content")


def read_office(spark: SparkSession, folder: str) -> DataFrame:
    """(source_file, source_type, page, raw_text): slides and document blocks of a folder tree, one row each.

    A file that can't be parsed gives one row with ``page`` and text null, so
    that it shows and stops nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("source_file", pa.string()), ("source_type", pa.string()), ("page", pa.int32()), ("raw_text", pa.string())])
        for batch in batches:
            for name, data in zip(*(c.to_pylist() for c in batch.columns)):
                kind = "ppt" if name.lower().endswith(".pptx") else "docx"
                try:
                    pages = slides(data) if kind == "ppt" else list(enumerate(blocks(paragraphs_and_cells(data)[0]), 1))
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
                    pages = [(None, None)]
                if pages:
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(pages), pa.string()), pa.array([kind] * len(pages), pa.string()), *(pa.array(c, t) for c, t in zip(zip(*pages), (pa.int32(), pa.string())))], schema=schema)

    return _files(spark, folder, "*.{pptx,docx}").mapInArrow(run, "source_file string, source_type string, page int, raw_text string")


def read_exercise_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(source_file, paragraphs, cells) of the documents of a folder tree, for ``exercises.document_questions``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = pa.list_(pa.string())
        for batch in batches:
            for name, data in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    paragraphs, cells = paragraphs_and_cells(data)
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
                    paragraphs, cells = None, None
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([paragraphs], lists), pa.array([cells], lists)], names=["source_file", "paragraphs", "cells"])

    return _files(spark, folder, "*.docx").mapInArrow(run, "source_file string, paragraphs array<string>, cells array<string>")
