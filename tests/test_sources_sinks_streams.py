import json
import random

import pytest
from pyspark.sql import functions as F

from tessella import sinks, sources, streaming
from tessella.operators import resolution


def test_texts_and_exercises(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.md").write_text("# 标题\n正文")
    (tmp_path / "sub" / "b.txt").write_bytes(b"ok \xff")
    (tmp_path / "c.pdf").write_text("no")
    got = {r.source_file: (r.source_type, r.raw_text) for r in sources.read_texts(spark, str(tmp_path)).collect()}
    assert got["a.md"] == ("md", "# 标题\n正文") and got["b.txt"][0] == "txt" and set(got) == {"a.md", "b.txt"}
    (tmp_path / "q.json").write_text(json.dumps({"questions": [{"id": "7", "question": "问", "options": ["A. x", "B. y"], "answer": "A"}, {"stem": "二", "options": {"A": "x"}, "explanation": "因为"}, {}]}, ensure_ascii=False))
    got = [(r.question_id, r.raw_text) for r in sources.read_exercises(spark, str(tmp_path / "q.json")).collect()]
    assert got == [("7", "题干：问\nA. x\nB. y\n答案：A"), ("2", "题干：二\nA. x\n解析：因为")]
    (tmp_path / "list.json").write_text(json.dumps([{"question": "只"}], ensure_ascii=False))
    assert [r.raw_text for r in sources.read_exercises(spark, str(tmp_path / "list.json")).collect()] == ["题干：只"]


def test_graph_json(spark, tmp_path):
    (tmp_path / "g.json").write_text(json.dumps({"nodes": [{"id": "a"}, {"id": "b"}], "edges": [{"source": "a", "target": "b"}]}))
    nodes, edges = sources.read_graph(spark, str(tmp_path / "g.json"), "id:string", "source:string,target:string")
    assert [(r.ord, r.id) for r in nodes.orderBy("ord").collect()] == [(0, "a"), (1, "b")] and edges.count() == 1


def test_statements_escape_and_sanitise(spark):
    df = spark.createDataFrame([('a"1', 'say "x"\n', "My Type-1")], "id string, name string, type string")
    aliases = spark.createDataFrame([('a"1', 'q"'), ('a"1', "p")], "id string, alias string")
    (row,) = sinks.node_statements(df, aliases).collect()
    assert row.statement == 'MERGE (n:KnowledgeNode:My_Type_1 {id: "a\\"1"})\nSET n += {name: "say \\"x\\"\\n", type: "My Type-1", aliases: ["p", "q\\""]};'


def test_swapped_write(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_swapped(spark.range(3), path)
    sinks.write_swapped(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5


def test_streams(spark, tmp_path):
    schema = "doc_key string, source_type string, raw_text string, loaded_at timestamp"
    rows = [("a", "pdf", "类与继承\n第 3 页", "2026-01-01 10:00:00"), ("a", "pdf", "类与继承\n第 3 页", "2026-01-03 10:00:00"), ("b", "txt", "  ", "2026-01-02 10:00:00"), ("c", "txt", "文本", "2026-01-02 11:00:00")]
    df = spark.createDataFrame(rows, "doc_key string, source_type string, raw_text string, loaded_at string").withColumn("loaded_at", F.to_timestamp("loaded_at"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in"))

    def drain(out, name, mode="append"):
        q = out.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return spark.table(name).collect()

    got = drain(streaming.cleaned(streaming.once(stream(), "doc_key", "loaded_at")), "cleaned_rows")
    assert sorted((r.doc_key, r.cleaned) for r in got) == [("a", "类与继承"), ("c", "文本")]
    counts = drain(streaming.arrivals(stream(), "loaded_at", "source_type"), "arrival_rows", "complete")
    assert sorted((str(r.start)[:10], r.source_type, r.n) for r in counts) == [("2026-01-01", "pdf", 1), ("2026-01-02", "txt", 2), ("2026-01-03", "pdf", 1)]
    for _ in range(2):
        streaming.upsert(df, str(tmp_path / "table"), "doc_key", "loaded_at")
    assert spark.read.parquet(str(tmp_path / "table")).count() == 3


def test_similar_names_equal_brute_force(spark):
    from difflib import SequenceMatcher

    names = ["abcdefghijkl", "abcdefghijkm", "abcdefghijk", "xabcdefghijklx", "zzzz", "zzz", "ab", "cab", "Ab-c", "abc", "索引树查找方法", "索引树查找办法", "树索引查找方法", "", None] + [f"prefix number {i} suffix" for i in range(0, 40, 3)]
    df = spark.createDataFrame([(f"r{i}", "T" if i % 7 else "U", n) for i, n in enumerate(names * 2)], "raw_id string, type string, name string")
    keys = {}
    for i, n in enumerate(names * 2):
        k = "".join(c for c in (n or "").lower() if c not in " -")
        if k:
            keys.setdefault("T" if i % 7 else "U", set()).add(k)
    want = set()
    for kind, ks in keys.items():
        for a in ks:
            for b in ks:
                if a < b and (SequenceMatcher(None, a, b).ratio() >= 0.88 or (a in b or b in a) and min(len(a), len(b)) > 2):
                    want.add((kind, a, b))
    got = {(r.type, r.left, r.right) for r in resolution.similar_names(df).collect()}
    assert got == want and len(want) > 10


def _alike(keys, least=0.88, shortest=2):
    from difflib import SequenceMatcher

    pairs = ((a, b) for a in keys for b in keys if a < b)
    return {(a, b): x for a, b in pairs if (x := SequenceMatcher(None, a, b).ratio()) >= least or (a in b or b in a) and min(len(a), len(b)) > shortest}


@pytest.mark.parametrize("least, shortest", [(0.88, 2), (0.93, 0), (0.88, 5), (0.75, 3)])
def test_similar_names_of_all_lengths_equal_brute_force(spark, least, shortest):
    dice = random.Random(f"{least} {shortest}")
    keys = {"".join(dice.choices("abcd类型", k=n)) for n in (*range(1, 32), 60, 230)} | {"𠮷野家", "𠮷野家𠮷", "a" * 12, "a" * 13, "a" * 14, "0000012", "00000123"}
    for name in sorted(keys) * 3:
        letters = list(name)
        for _ in range(dice.randint(1, 1 + len(letters) // 9)):
            at = dice.randrange(len(letters) + 1)
            letters[at : at + dice.randint(0, 1)] = dice.choices("abcd类型", k=dice.randint(0, 1))
        keys |= {"".join(letters)} - {""}
    rows = spark.createDataFrame([(i, "T", k) for i, k in enumerate(sorted(keys))], "raw_id long, type string, name string")
    got = resolution.similar_names(rows, least, shortest).collect()
    want = _alike(keys, least, shortest)
    assert sorted((r.left, r.right) for r in got) == sorted(want) and all(abs(r.ratio - want[r.left, r.right]) < 6e-5 for r in got)


def test_similar_names_of_few_words_are_compared_with_few_others(spark):
    """Names put together from few words share their words with most others; that alone must not pair them."""
    first, last = [chr(0x4E00 + 2 * i) + chr(0x4E01 + 2 * i) for i in range(12)], [chr(0x5E00 + 3 * i) + chr(0x5E01 + 3 * i) + chr(0x5E02 + 3 * i)[: i % 2] for i in range(20)]
    keys = {a + b + c for a in first for b in ["", *first] for c in last}
    rows = spark.createDataFrame([("T", k) for k in sorted(keys)], "type string, name string")
    n, pairs = resolution.similar_candidates(rows, 0.88, 2).count(), resolution.similar_names(rows).count()
    assert pairs >= 12 * 12 * 20 and n <= 1.5 * pairs
