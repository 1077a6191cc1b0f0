import pytest
from pyspark.sql import functions as F

from tessella import service, sinks
from tessella.operators import decisions as d
from tessella.operators import extraction as x
from tessella.operators import matching, programming, resolution, views
from tessella.operators import questions as q
from tessella.operators import reports as rp


def test_model_links_fall_back_to_rules(spark):
    answers = spark.createDataFrame([("q1", 0, " B ", "primary", 0.9), ("q1", 1, "A", "odd", None), ("q1", 2, "B", "secondary", 0.1), ("q1", 3, "no", "primary", 1.0), ("q2", 0, "no", "primary", 1.0)], "question_id string, at int, name string, role string, confidence double")
    found = spark.createDataFrame([("q1", "A", "a"), ("q1", "B", "b"), ("q2", "C", "c")], "question_id string, name string, id string")
    rules = spark.createDataFrame([("q1", "A", "a", "primary", 0.9, 1), ("q2", "C", "c", "primary", 0.8, 1)], "question_id string, name string, id string, role string, confidence double, place int")
    got = {tuple(r) for r in d.model_links(answers, found, rules).collect()}
    assert got == {("q1", "B", "b", "primary", 0.9, 1), ("q1", "A", "a", "secondary", 0.6, 2), ("q2", "C", "c", "primary", 0.8, 1)}
    assert d.model_links(answers.limit(0), found, rules).count() == 2


def test_reviews_keep_repair_or_doubt(spark):
    relations = spark.createDataFrame([(i, "KnowledgePoint", "part_of", t, 0.5) for i, t in (("keep", "KnowledgeUnit"), ("wrong", "Skill"), ("unsure", "KnowledgeUnit"), ("drop", "KnowledgeUnit"), ("none", "KnowledgeUnit"))], "id string, source_type string, type string, target_type string, confidence double")
    made = spark.createDataFrame([("keep", "KEEP", "Prerequisite_Of", 0.9, 2), ("keep", "drop", None, 0.9, 1), ("wrong", "repair", "part_of", 0.9, 1), ("unsure", "keep", None, 0.2, 1), ("drop", None, None, 0.9, 1)], "id string, action string, relation_type string, confidence double, ord int")
    got = {r.id: (r.new_type, r.reason) for r in d.reviewed_relations(relations, made).collect()}
    assert got == {"keep": ("prerequisite_of", None), "wrong": ("part_of", "type"), "unsure": ("part_of", "confidence"), "drop": ("part_of", "action"), "none": ("part_of", None)}


def test_completed_answers_and_approval(spark):
    questions = spark.createDataFrame([("own", "A", "w"), ("good", "", ""), ("weak", None, None), ("none", " ", None)], "question_id string, answer string, analysis string")
    made = spark.createDataFrame([("good", "standard_answer", "x", "y", 0.95), ("weak", "odd", "x", "y", 0.95)], "question_id string, answer_kind string, answer string, analysis string, confidence double")
    seen = spark.createDataFrame([("good", True, "better", None, 0.9), ("weak", True, None, None, float("nan"))], "question_id string, accepted boolean, answer string, analysis string, confidence double")
    rows = d.completed_answers(questions, made, seen)
    got = {r.question_id: (r.answer, r.answer_source, r.answer_kind, r.answer_status, r.answer_confidence) for r in rows.collect()}
    assert got["own"] == ("A", "provided", "standard_answer", "verified", 1.0) and got["good"] == ("better", "llm_generated", "standard_answer", "verified", 0.9)
    assert got["weak"] == ("x", "llm_generated", "reference_solution", "needs_review", 0.0) and got["none"][1:4] == ("missing", "unknown", "needs_generation")
    ok = rows.where(d.approved(F.col("answer_source"), F.col("answer"), F.col("answer_status"), F.col("answer_confidence")))
    assert {r.question_id for r in ok.collect()} == {"own", "good"}
    assert [r.question_id for r in d.within_budget(questions, [F.col("question_id")], 2).collect()] == ["good", "none"]


def test_questions_and_merges_that_need_a_model(spark):
    found = spark.createDataFrame([("a", 1, 9.0), ("a", 2, 3.0), ("b", 1, 9.0), ("b", 2, 8.0), ("c", 1, 1.0)], "question_id string, place int, score double")
    assert {r.question_id: r.needed for r in d.questions_needing_model(found).collect()} == {"a": False, "b": True, "c": False}
    df = spark.createDataFrame([(True, 0.9, "Skill"), (True, 0.9, "x"), (None, 0.9, "Skill"), (True, None, "Skill")], "m boolean, c double, t string")
    assert [r[0] for r in df.select(d.accepted_merge(F.col("m"), F.col("c"), F.col("t"))).collect()] == [True, False, False, False]


def test_all_repair_rules(spark):
    c, p, lang, syn = "OOPConcept", "ProgrammingParadigm", "ProgrammingLanguage", "SyntaxRule"
    rules = [
        (("h", c, "part_of", "t", p), ("h", c, "belongs_to_paradigm", "t", p)),
        (("h", c, "part_of", "t", lang), ("h", c, "implemented_in", "t", lang)),
        (("h", p, "belongs_to_paradigm", "t", c), ("t", c, "belongs_to_paradigm", "h", p)),
        (("h", lang, "belongs_to_paradigm", "t", p), ("t", p, "implemented_in", "h", lang)),
        (("h", c, "has_code_structure", "t", c), ("t", c, "part_of", "h", c)),
        (("h", syn, "has_syntax", "t", c), ("t", c, "has_syntax", "h", syn)),
        (("h", c, "expresses_concept", "t", c), ("h", c, "part_of", "t", c)),
        (("h", c, "part_of", "t", c), ("h", c, "part_of", "t", c)),
    ]
    df = spark.createDataFrame([(i, *r[0]) for i, r in enumerate(rules)], "i int, head string, head_type string, relation string, tail string, tail_type string")
    assert [tuple(r)[1:] for r in x.repaired(df).select("i", "head", "head_type", "relation", "tail", "tail_type").orderBy("i").collect()] == [r[1] for r in rules]


def test_rules_find_entities_and_relations(spark):
    chunk = spark.createDataFrame([("c1", "class Dog extends Animal { }", "Java", None), ("c2", None, None, None)], "chunk_id string, content string, language string, material_role string")
    got = {(r.head, r.relation, r.tail) for r in x.rule_relations(chunk).collect()}
    assert {("Dog", "inherits_from", "Animal"), ("类", "has_syntax", "class"), ("CodeExample_c1", "contains_structure", "Dog"), ("CodeExample_c1", "uses_syntax", "extends"), ("extends", "implemented_in", "Java")} <= got
    assert {r.name for r in x.rule_entities(chunk).where("type = 'CodeStructure'").collect()} == {"Dog", "Animal"}
    merged = x.merged_relations(x.rule_relations(chunk))
    assert {r.relation for r in merged.collect()} <= set(x.EXTRACTED_SCHEMA)
    entities = x.merged_entities(x.rule_entities(chunk))
    assert x.completed_entities(entities.where("name <> 'Dog'"), merged).select("name", "type").collect() == [("Dog", "CodeStructure")]


def test_ends_resolve_by_normal_or_given_names(spark):
    entities = spark.createDataFrame([("e1", "方法", "KnowledgePoint", "Method！", "概念", "1"), ("e2", "方法", "KnowledgePoint", "方法", "KnowledgePoint", "2"), ("e3", "Ab", "odd", "A-b", "odd", "3")], "id string, name string, type string, original_name string, original_type string, ord string")
    relations = spark.createDataFrame([("r1", "method", "概念", "a b", "odd"), ("r2", None, "概念", "zz", "Skill")], "id string, head string, head_type string, tail string, tail_type string")
    assert {tuple(r) for r in resolution.resolve_endpoints(relations, entities).select("id", "head_id", "tail_id").collect()} == {("r1", "e2", "e3"), ("r2", None, None)}
    names = spark.createDataFrame([("ｆｏｒ 循环",), ("java 语言",), (" OOP；",), ("成员方法",), (None,)], "n string")
    assert [r[0] for r in names.select(resolution.canonical_name(F.col("n"))).collect()] == ["for循环", "Java", "面向对象编程", "方法", ""]
    kinds = spark.createDataFrame([("PART_OF",), ("属于",), ("Odd",), (None,)], "t string")
    assert [r[0] for r in kinds.select(resolution.canonical_relation(F.col("t"), ("part_of",))).collect()] == ["part_of", "part_of", "odd", ""]
    ends = relations.withColumn("confidence", F.lit(0.9))
    assert {(r.name, r.type, round(r.confidence, 2)) for r in resolution.inferred_entities(ends, entities).collect()} == {("zz", "Skill", 0.85)}


def test_containment_by_automaton_and_by_join_agree(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "abcdef abc"), (2, "xyz"), (3, None), (4, ""), (1, "abcdef abc")], "id int, t string")
    phrases = spark.createDataFrame([("abc",), ("bcde",), ("yz",), ("nope",), ("",), (None,)], "p string")
    run = lambda: sorted(tuple(r) for r in matching.containing(texts, "id", "t", phrases, "p").collect())
    want = [(1, "abc"), (1, "bcde"), (2, "yz")]
    assert run() == want
    monkeypatch.setattr(matching, "SENT", 1)
    assert run() == want
    assert matching.containing(texts, "id", "t", phrases.limit(0), "p").collect() == []


def test_cycles_are_found_however_long_the_way(spark):
    chain = [(f"n{i:05d}", f"n{i + 1:05d}") for i in range(3000)]
    ring = [("a", "b"), ("b", "c"), ("c", "a"), ("x", "a"), ("c", "y"), ("s", "s")]
    df = spark.createDataFrame(chain + ring, "source string, target string")
    want = {("a", "b"), ("b", "c"), ("c", "a"), ("s", "s")}
    assert {tuple(r) for r in views.cyclic_part(df).collect()} == want
    assert {tuple(r) for r in views.cyclic_part(spark.createDataFrame(ring, "source string, target string"), finish=2).collect()} == want
    assert views.cyclic_part(df.limit(0)).collect() == []


def test_mapping_and_messages(spark):
    nodes = spark.createDataFrame([("k1", "类", "KnowledgePoint")], "id string, name string, type string")
    aliases = spark.createDataFrame([("k1", "Class")], "id string, alias string")
    questions = spark.createDataFrame([("q1",), ("q2",)], "question_id string")
    links = spark.createDataFrame([("q1", "K1", "x"), ("q1", "no", "CLASS"), ("q9", None, None)], "question_id string, knowledge_id string, knowledge_name string")
    row = rp.mapping_integrity(links, questions, nodes, aliases).first()
    assert (row.links, row.invalid_node_ids, row.fallback_name_matches, row.unresolved_links, row.invalid_question_ids, row.questions_without_mapping) == (3, 2, 1, 1, 1, 1)
    counts = "invalid_edges int, self_loops int, isolated_nodes int, unresolved_links int, questions_without_mapping int"
    df = spark.createDataFrame([(0, 0, 0, 0, 0), (2, 0, 0, 1, 0)], counts)
    assert [r[0] for r in df.select(views.health_message(F.struct("*"))).collect()] == ["正常", "2 个无效关系，1 个未解析映射"]


def test_release_audit_names_what_is_wrong(spark):
    nodes = spark.createDataFrame([("d", "KnowledgeDomain", "域"), ("p", "KnowledgePoint", "点"), ("p", "KnowledgePoint", "点"), ("s", "CodeStructure", "A")], "id string, type string, name string")
    raw = spark.createDataFrame([("e1", "p", "part_of", "d"), ("e2", "p", "part_of", "zz"), ("e3", "p", "prerequisite_of", "p")], "id string, source string, type string, target string")
    questions = spark.createDataFrame([("q", "")], "question_id string, answer string")
    links = spark.createDataFrame([("q", "p", "无", "primary")], "question_id string, knowledge_id string, knowledge_name string, role string")
    aliases = spark.createDataFrame([("d", "点")], "id string, alias string")
    examples = spark.createDataFrame([(1, False)], "row_id int, complete boolean")
    got = {r.check: r.violations for r in rp.release_audit(nodes, raw, raw.unionByName(raw.limit(1)), questions, links, aliases, examples).collect()}
    assert len(got) == 19
    wrong = {"unique_node_ids", "no_dangling_edges", "no_self_loops", "no_duplicate_edges", "formal_schema_valid", "nodes_connected", "prerequisite_dag_valid", "aliases_valid", "code_examples_valid", "code_structures_scoped", "formal_answers_present", "mapping_references_valid"}
    assert {k for k, v in got.items() if v} == wrong
    with pytest.raises(Exception, match="title"):
        rp.require_complete(examples).collect()


def test_catalog_scores(spark):
    df = spark.createDataFrame([("int x;", 9), ("课程安排", 0), ("课程安排 python", 2), (None, None)], "t string, n int")
    assert [r[0] for r in df.select(programming.relevance(F.col("t"), F.col("n"))).collect()] == [10, -3, 5, 0]


def test_overview_rings(spark):
    roots = spark.createDataFrame([("a", "A"), ("b", "B")], "id string, label string")
    second = spark.createDataFrame([(f"s{i}", f"S{i}", "a") for i in range(9)], "id string, label string, root string")
    got = {r.id: (r.layer, r.x, r.y) for r in views.overview_positions(roots, second, second.limit(0)).collect()}
    assert got["a"] == (1, 0.0, -250.0) and got["b"] == (1, 0.0, 250.0)
    radius = {k: round((x * x + y * y) ** 0.5) for k, (_, x, y) in got.items()}
    assert [radius[f"s{i}"] for i in range(9)] == [440, 555] * 4 + [440]


def test_listing_search_and_keyword_evidence(spark):
    schema = "question_id string, stem string, code string, answer string, analysis string, options array<string>, abilities array<string>, gold array<struct<name:string,role:string>>, type string"
    rows = spark.createDataFrame([("q1", "封装与 private", "", "", "", [], [], [("类", "primary")], "x"), ("q2", "无关", "", "", "", [], ["能力"], [], "x")], schema)
    nodes = spark.createDataFrame([("n1", "封装", "KnowledgePoint", 1, ""), ("n2", "信息隐藏", "KnowledgePoint", 2, ""), ("n3", "类", "KnowledgePoint", 3, "")], "id string, name string, type string, ord bigint, description string")
    aliases, edges = spark.createDataFrame([], "id string, alias string"), spark.createDataFrame([("n1", "n3")], "source string, target string")
    got = {r.name: (r.score, r.evidence) for r in q.candidates(rows, nodes, aliases, edges).collect()}
    assert got["封装"] == (7.0, ["名称：封装", "特征：private", "特征：封装"]) and got["信息隐藏"][0] == 4.0 and got["类"] == (0.8, ["邻居：封装"])
    assert [r.question_id for r in q.listed(rows, "能力", 0).collect()] == ["q2"] and q.listed(rows, "", 1).count() == 1
    assert [tuple(r) for r in rp.search(nodes, rows, " 封装 ").collect()] == [("knowledge", "n1", "KnowledgePoint"), ("question", "q1", "x")]
    assert rp.search(nodes, rows, " ").count() == 0
    links = spark.createDataFrame([("q2", "n1", "封装")], "question_id string, id string, name string")
    assert {r.question_id for r in q.questions_of(nodes.where("id IN ('n1', 'n3')").select("id"), nodes, aliases, rows, links).collect()} == {"q1", "q2"}


def test_routes_and_errors(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    assert service.call(spark, folder, "schema").count() > 0
    some = service.call(spark, folder, "graph")["nodes"].orderBy("id").first().id
    assert service.call(spark, folder, "nodes", id=some)["node"].count() == 1
    assert service.call(spark, folder, "graphs", id=some, depth="2")["nodes"].count() >= 1
    assert service.call(spark, folder, "questions", limit="3").count() == 3
    for route, given, status in (("nope", {}, 404), ("nodes", {"id": "no such"}, 404), ("search", {"q": "a", "limit": "x"}, 400), ("nodes", {}, 400)):
        with pytest.raises(service.ServiceError) as error:
            service.call(spark, folder, route, **given)
        assert error.value.status == status
    assert service.main(["health", "--tables", folder, "--output", str(tmp_path / "out")]) == 0
    assert spark.read.json(str(tmp_path / "out")).count() == 1
    assert service.main(["question", "--tables", folder, "--output", str(tmp_path / "o2"), "--set", "id=none"]) == 1


def test_scripts(spark):
    nodes = spark.createDataFrame([("a", "A", "T")], "id string, name string, type string")
    edges = spark.createDataFrame([("e", "a", "a", "part_of")], "id string, source string, target string, type string")
    aliases = spark.createDataFrame([], "id string, alias string")
    steps = [r.statement.split(" ")[0] for r in sinks.graph_script(nodes, edges, aliases, wipe=True).orderBy("step").collect()]
    assert steps == ["CREATE", "MATCH", "MERGE", "MATCH"]
    assert "[r:`包含` {id: \"e\"}]" in sinks.localized_edge_statements(edges, {"part_of": "包`含"}).first().statement
