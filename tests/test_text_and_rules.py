import pytest
from pyspark.sql import functions as F

from tessella.functions import coerce as k
from tessella.operators import cleaning as c
from tessella.operators import extraction as x
from tessella.operators import matching, questions, resolution


def one(spark, column, **values):
    kinds = {str: "string", int: "int", float: "double", type(None): "string"}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} {kinds[type(v)]}" for n, v in values.items()))
    return df.select(column.alias("r")).first().r


def test_cleaning(spark):
    got = one(spark, c.clean_text(F.col("t")), t="　第 3 页\r\n  a\t b \x07\n\nThank  you\n目录\nReferences\n7\n内容")
    assert got == "a b\n内容"
    assert one(spark, c.clean_text(F.col("t")), t=None) == ""
    assert one(spark, c.guess_title(F.col("t")), t="\n　 \n 标题 \nx") == "标题"


def test_three_long_sentences_pack_in_two_and_one(spark):
    sentence = "x" * 199 + "."
    got = one(spark, c.chunk_texts(F.col("t"), F.lit("pdf")), t=" ".join([sentence] * 3))
    assert [len(p) for p in got] == [401, 200]


def test_bullets_open_blocks_and_exercises_stay_whole(spark):
    text = "head line\n- first point\ngoes on\n2. second point"
    assert one(spark, c.chunk_texts(F.col("t"), F.lit("pdf")), t=text) == ["head line", "- first point goes on", "2. second point"]
    assert one(spark, c.chunk_texts(F.col("t"), F.lit("exercise")), t=text) == [text]
    assert one(spark, c.chunk_texts(F.col("t"), F.lit("pdf")), t="short") == []


def test_term_replacements_cascade_in_order(spark):
    assert one(spark, c.normal_terms(F.col("t")), t="A Class has a METHOD") == "A 类 has a 方法"
    assert one(spark, c.normal_terms(F.col("t"), (("a", "bb"), ("b", "c"))), t="a") == "cc"


def test_word_boundaries_are_unicode(spark):
    assert one(spark, x.syntax_in(F.col("t")), t="类class类 super") == ["super"]


def test_structures(spark):
    df = spark.createDataFrame([("c", "public class A extends B { void run() {} }"), ("d", None)], "chunk_id string, content string")
    assert {(r.name, r.kind) for r in x.structures(df).collect()} == {("A", "class"), ("run", "method")}
    assert [tuple(r) for r in x.structure_links(df).collect()] == [("c", "A", "inherits_from", "B")]


def test_repairs(spark):
    rows = [("封装", "OOPConcept", "part_of", "P", "ProgrammingParadigm"), ("P", "ProgrammingParadigm", "belongs_to_paradigm", "类", "OOPConcept"), ("class", "OOPConcept", "expresses_concept", "类", "OOPConcept"), ("a", "SyntaxRule", "has_syntax", "b", "OOPConcept"), ("u", "X", "part_of", "v", "Y")]
    df = spark.createDataFrame(rows, "head string, head_type string, relation string, tail string, tail_type string")
    assert {(r.head, r.relation, r.tail) for r in x.repaired(df).collect()} == {("封装", "belongs_to_paradigm", "P"), ("类", "belongs_to_paradigm", "P"), ("class", "part_of", "类"), ("b", "has_syntax", "a"), ("u", "part_of", "v")}


@pytest.mark.parametrize("value, want", [(0.0, 0.77), (float("nan"), 0.05), (2.0, 0.98), (0.6, 0.65)])
def test_confidence_with_evidence(spark, value, want):
    assert one(spark, k.adjusted_confidence(F.col("c"), F.lit("is"), F.lit("this"), 0.72), c=value) == want


def test_confidence_without_evidence_and_clamps(spark):
    assert one(spark, k.adjusted_confidence(F.col("c"), F.lit(None).cast("string"), F.lit("t"), 0.72), c=0.6) == 0.52
    assert one(spark, k.safe_float(F.col("c"), 0.5), c="nan") == 0.0
    assert one(spark, k.safe_float(F.col("c"), 0.5), c="x") == 0.5
    assert one(spark, k.safe_float(F.col("c"), 0.5), c="-3") == 0.0


@pytest.mark.parametrize("value, want", [(0.625, 62), (0.1, 45), (70.0, 70), (500.0, 95), (-1.0, 64), (float("nan"), 64)])
def test_strength_rounds_half_even(spark, value, want):
    assert one(spark, k.strength(F.col("c")), c=value) == want


def test_containment_join_equals_brute_force(spark):
    texts = {"a": "abcabcabd", "b": "xy", "c": "", "d": "ab"}
    phrases = ["abc", "abd", "x", "abcabcabd", "zz", "", "ab"]
    got = matching.containing(spark.createDataFrame(list(texts.items()) + [("e", None)], "id string, t string"), "id", "t", spark.createDataFrame([(p,) for p in phrases + ["ab"]] + [(None,)], "p string"), "p")
    assert {tuple(r) for r in got.collect()} == {(i, p) for i, t in texts.items() for p in phrases if p and p in t}


def test_evaluation_of_links(spark):
    gold = spark.createDataFrame([("1", [("a", "primary")]), ("2", [("a", "primary")])], "question_id string, gold array<struct<name:string,role:string>>")
    links = spark.createDataFrame([("1", "A ", "primary", 1), ("1", "b", "secondary", 2)], "question_id string, name string, role string, place int")
    rows = {r.question_id: r for r in questions.evaluation(gold, links).collect()}
    assert (rows["1"].precision, rows["1"].recall, rows["1"].f1, rows["1"].primary_hit) == (0.5, 1.0, 0.6667, True)
    assert (rows["2"].precision, rows["2"].recall, rows["2"].f1, rows["2"].unmapped) == (0.0, 0.0, 0.0, True)


def test_resolution(spark):
    assert one(spark, resolution.normal_name(F.col("t")), t="　Ｊａｖａ  x - y。 ") == "Java x-y"
    assert one(spark, resolution.normal_type(F.col("t")), t=" 概念 ") == "KnowledgePoint"
    links = spark.createDataFrame([(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)] + [("z", "z"), (None, "n000"), ("p", "q"), ("q", "p")], "a string, b string")
    got = {r.vertex: r.root for r in resolution.union_groups(links).collect()}
    assert got == {f"n{i:03d}": "n000" for i in range(61)} | {"p": "p", "q": "p"}
