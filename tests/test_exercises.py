import io
import zipfile

from pyspark.sql import functions as F

from tessella import sources
from tessella.operators import exercises as ex
from tessella.sources.office import blocks, paragraphs_and_cells, read_exercise_documents, read_office, slides

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
A = 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main"'


def zipped(**files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in files.items():
            z.writestr(name.replace("__", "/").replace("_xml", ".xml"), text)
    return out.getvalue()


def document(paragraphs, cells=()):
    p = lambda t: f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>"
    table = f"<w:tbl>{''.join(f'<w:tr><w:tc>{p(c)}</w:tc></w:tr>' for c in cells)}</w:tbl>" if cells else ""
    return zipped(word__document_xml=f"<w:document {W}><w:body>{''.join(map(p, paragraphs))}{table}</w:body></w:document>")


def presentation(*pages):
    slide = lambda texts, rows: f"<p:sld {A}>" + "".join(f"<p:sp><p:txBody><a:p><a:r><a:t>{t}</a:t></a:r></a:p></p:txBody></p:sp>" for t in texts) + "".join(f"<a:tbl><a:tr>{''.join(f'<a:tc><a:txBody><a:p><a:r><a:t>{c}</a:t></a:r></a:p></a:txBody></a:tc>' for c in r)}</a:tr></a:tbl>" for r in rows) + "</p:sld>"
    return zipped(**{f"ppt__slides__slide{i}_xml": slide(*page) for i, page in enumerate(pages, 1)})


TEXTS = ["前言不算", "第1篇 继承", "1. 定义一个类，说明继承的作用，并给出完整的程序和输出结果。", "class A {", "}", "2. 太短", "第3篇 常见错误", "3. 这里是答案，定义一个类，说明它的错误所在，不应当成为习题。", "第2篇 多态", "Please write the output of the template program given here."]


def test_documents_and_slides():
    assert paragraphs_and_cells(document(["a", " ", "b"], ["x", ""])) == (["a", "b"], ["x"])
    assert slides(presentation((["题目"], []), ([], []), (["第三"], [["a", "", "b"]]))) == [(1, "题目"), (3, "第三\na | b")]
    assert blocks([f"段{i}" for i in range(13)]) == ["\n".join(f"段{i}" for i in range(12)), "段12"]
    assert blocks(["正文", "第一章 开头", "后文"]) == ["正文\n第一章 开头", "后文"]
    assert blocks([]) == []


def test_folder_of_everything(spark, tmp_path):
    (tmp_path / "_converted_pptx").mkdir()
    (tmp_path / "a.docx").write_bytes(document(["一段", "二段"]))
    (tmp_path / "b.pptx").write_bytes(presentation((["页"], [])))
    (tmp_path / "broken.docx").write_bytes(b"no zip")
    (tmp_path / "_converted_pptx" / "c.pptx").write_bytes(presentation((["不读"], [])))
    (tmp_path / "t.md").write_text("# 标题\n正文")
    (tmp_path / "q.json").write_text('[{"id": "7", "question": "问"}]')
    got = {(r.source_file, r.page, r.raw_text) for r in read_office(spark, str(tmp_path)).collect()}
    assert got == {("a.docx", 1, "一段\n二段"), ("b.pptx", 1, "页"), ("broken.docx", None, None)}
    rows = {(r.source_file, r.source_type, r.question_id, r.title) for r in sources.read_folder(spark, str(tmp_path)).collect()}
    assert rows == {("a.docx", "docx", None, "一段"), ("b.pptx", "ppt", None, "页"), ("t.md", "md", None, "# 标题"), ("q.json", "exercise", "7", "题干：问")}


def test_question_blocks_sections_and_answers(spark):
    df = spark.createDataFrame([(1, TEXTS), (2, []), (3, ["第1篇", "打开文件，写出程序的输出并说明它为什么会有这样的结果？好"])], "k int, ls array<string>")
    got = [(r.k, r.section, r.first, r.last, r.lines) for r in df.select("k", F.inline(ex.question_blocks(F.col("ls")))).orderBy("k", "first").collect()]
    assert got == [(1, "第1篇 继承", 3, 5, TEXTS[2:5]), (1, "第2篇 多态", 10, 10, TEXTS[9:])]


def test_kinds_code_and_records(spark, tmp_path):
    (tmp_path / "e.docx").write_bytes(document(TEXTS, ["short", "int main() { return 0; } // fix me"]))
    (tmp_path / "bad.docx").write_bytes(b"x")
    docs = read_exercise_documents(spark, str(tmp_path))
    got = {r.question_id: r for r in ex.document_questions(docs, "source_file", F.col("paragraphs"), F.col("cells")).collect()}
    assert sorted(got) == ["CPP_DOCX_001", "CPP_DOCX_002", "CPP_DOCX_003"]
    one, two, three = (got[k] for k in sorted(got))
    assert (one.kind, one.code, one.stem, one.difficulty) == ("code_reading", "class A {\n}", TEXTS[2], 3)
    assert (two.kind, two.difficulty, two.abilities) == ("code_reading", 4, ["代码阅读", "运行结果分析"])
    assert (three.kind, three.code, three.stem[:2]) == ("code_fixing", "int main() { return 0; } // fix me", "指出")
    df = spark.createDataFrame([(["改错：下面的代码"],), (["Define a thing"],), (["x = 1;"],), (["随便"],), (["{"],)], "ls array<string>")
    assert [r[0] for r in df.select(ex.question_kind(F.col("ls"))).collect()] == ["code_fixing", "short_programming", "code_reading", "short_programming", "code_reading"]
    assert tuple(df.where("ls[0] = '{'").select(ex.stem_and_code(F.col("ls"))).first()[0]) == ("{", "{")


def test_listed_readers(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"items": [{"id": "b"}, {"id": "a"}]}')
    (tmp_path / "c.json").write_text('[{"id": "x"}, {"id": "y"}]')
    (tmp_path / "bad.json").write_text('"no"')
    assert [r.id for r in sources.read_links(spark, str(tmp_path / "l.json"), "id:string").orderBy("ord").collect()] == ["b", "a"]
    paths = [str(tmp_path / "none.json"), str(tmp_path / "c.json")]
    assert sources.first_existing(spark, [None, *paths]) == paths[1] and sources.first_existing(spark, paths[:1]) == paths[0]
    assert [r.id for r in sources.read_listed(spark, paths, "chunks", "id:string").orderBy("ord").collect()] == ["x", "y"]
    assert [r.id for r in sources.read_chunks(spark, paths[1], "id:string", 1).collect()] == ["x"]
    for path, error in ((str(tmp_path / "bad.json"), Exception), (paths[0], FileNotFoundError)):
        try:
            sources.read_listed(spark, [path], "chunks", "id:string").collect()
            raise AssertionError(path)
        except error as e:
            assert not isinstance(e, AssertionError)
    nodes, edges = sources.read_graph_or_empty(spark, paths[0], "id:string", "source:string,target:string")
    assert nodes.count() == edges.count() == 0
    (tmp_path / "x.json").write_text('{"examples": [{"id": "1", "code": "old"}, {"id": "1", "local_id": "l", "code": "new"}, {"id": "2"}, {"code": "z"}]}')
    stored = sources.read_code_examples(spark, str(tmp_path / "x.json"))
    assert [(r.id, r.code) for r in stored.collect()] == [("1", "new")]
    rows = spark.createDataFrame([("1", None, [("a",)]), ("9", "l", None), ("8", None, [("p",), (" ",), ("q",)])], "id string, local_id string, sources array<struct<content:string>>")
    assert {r.id: (r.text, r.stored) for r in sources.original_question(rows, stored).collect()} == {"1": ("new", True), "9": ("new", True), "8": ("p\n\nq", False)}
