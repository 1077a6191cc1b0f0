import random

from tessella.llm.components import components, entity_links


def brute(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def run(spark, links, **k):
    return {r.vertex: r.group_id for r in components(spark.createDataFrame(links, "l string, r string"), "l", "r", **k).collect()}


def test_shapes(spark):
    rnd = random.Random(2)
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(70)]
    rnd.shuffle(chain)
    star = [("hub", f"s{i}") for i in range(50)]
    ring = [(f"r{i}", f"r{(i + 1) % 20}") for i in range(20)]
    loose = [(f"n{rnd.randrange(60)}", f"n{rnd.randrange(60)}") for _ in range(50)]
    odd = [("a", "a"), (None, "b"), ("b", None), ("x", "y"), ("y", "x"), ("x", "y")]
    links = chain + star + ring + loose + odd
    assert run(spark, links) == run(spark, links, finish=0) == brute(links)


def test_empty_and_self_links_only(spark):
    assert run(spark, []) == {}
    assert run(spark, [("a", "a"), (None, None)]) == {}


def test_entity_links(spark):
    prepared = spark.createDataFrame([("a", "left_id"), ("b", ""), ("c", ""), ("d", ""), (None, "")], "raw_id string, left_id string")
    matches = spark.createDataFrame([("b", "a", "same"), ("a", "b", "same"), ("a", "c", "Same"), ("a", "zz", "same"), ("c", "c", "same"), ("c", "d", None)], "left_id string, right_id string, verdict string")
    nodes = spark.createDataFrame([(["c", None, " ", "zz", "d"],), (["a"],), (None,), ([],)], "original_entity_ids array<string>")
    assert {tuple(r) for r in entity_links(prepared, matches, nodes).collect()} == {("a", "b"), ("c", "d")}
