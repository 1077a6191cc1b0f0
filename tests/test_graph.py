"""The small query-store graph, and edge cases of the graph operators."""

from tessella.operators import graph as g

NODES = [("course_python", "Python", "Course"), ("domain", "课程", "KnowledgeDomain"), ("unit", "单元", "KnowledgeUnit"), ("point", "排序", "KnowledgePoint"), ("example", "示例", "CodeExample"), ("lonely", "孤立", "KnowledgePoint")]
EDGES = [("course-domain", "domain", "course_python", "part_of"), ("domain-unit", "unit", "domain", "part_of"), ("unit-point", "point", "unit", "part_of"), ("example-point", "point", "example", "has_code_example"), ("self-loop", "unit", "unit", "has_syntax"), ("invalid", "missing", "point", "part_of")]


def graph(spark):
    nodes = spark.createDataFrame([(i, n, t, None, 0.9, k) for k, (i, n, t) in enumerate(NODES)], "id string, name string, type string, description string, confidence double, ord bigint")
    edges = spark.createDataFrame([(i, s, t, k, 0.8, None, j) for j, (i, s, t, k) in enumerate(EDGES)], "id string, source string, target string, type string, confidence double, evidence string, ord bigint")
    return nodes, edges


def test_health_counters(spark):
    row = g.integrity(*graph(spark)).first()
    assert (row.nodes, row.edges, row.invalid_edges, row.self_loops, row.isolated_nodes) == (6, 6, 1, 1, 1)


def test_overview_layers(spark):
    nodes, edges = graph(spark)
    got = {r.id: r.layer for r in g.hierarchy_overview(nodes, edges, "Course", "KnowledgeDomain").collect()}
    assert got == {"course_python": 1, "domain": 2, "unit": 3}


def test_unit_view_holds_unit_and_point(spark):
    nodes, edges = graph(spark)
    got = {r.id for r in g.focus_edges(edges, nodes, "unit").collect()}
    assert got == {"domain-unit", "unit-point"}
    assert g.focus_edges(edges, nodes, "nobody").collect() == []


def test_point_view_and_example_home(spark):
    nodes, edges = graph(spark)
    assert {r.id for r in g.focus_edges(edges, nodes, "point").collect()} == {"unit-point", "example-point"}
    assert [(r.example, r.home) for r in g.example_home(edges, nodes).collect()] == [("example", "point")]


def test_degree_of_a_loop_is_two_and_it_is_its_own_neighbour(spark):
    _, edges = graph(spark)
    assert {r.id: r.degree for r in g.degrees(edges).collect()}["unit"] == 4
    assert {r.id: r.neighbours for r in g.neighbour_counts(edges).collect()}["unit"] == 3


def test_hops_are_clamped(spark):
    _, edges = graph(spark)
    start = spark.createDataFrame([("course_python",)], "id string")
    assert {r.id: r.hops for r in g.within_hops(edges, start, 9).collect()} == {"course_python": 0, "domain": 1, "unit": 2, "point": 3}


def test_merging_rows_of_a_node(spark):
    rows = spark.createDataFrame(
        [(2, " A ", "late", None, 1.7, ["x"], "longer text"), (1, "a", "early", "T", 0.4, ["x", " y "], "short"), (3, "  ", "blank", "T", 0.5, None, None), (4, None, None, None, None, None, None)],
        "row_id bigint, id string, name string, type string, confidence double, aliases array<string>, description string",
    )
    (node,) = g.graph_nodes(rows).collect()
    assert (node.id, node.name, node.type, node.description, node.confidence) == ("a", "early", "T", "longer text", 0.4)
    assert {tuple(r) for r in g.node_aliases(rows).collect()} == {("a", "x"), ("a", "y")}


def test_empty_graph(spark):
    nodes, edges = (d.limit(0) for d in graph(spark))
    assert g.degrees(edges).collect() == [] and g.top_examples(edges, nodes).collect() == []
    assert g.integrity(nodes, edges).first().nodes == 0
