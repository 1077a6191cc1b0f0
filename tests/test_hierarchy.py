import hashlib
import random

import tracemalloc

from tessella.operators.hierarchy import contract, contract_light, descendants, hierarchy_table, resolve_hierarchy, resolve_roots

SCHEMA = "id string, parent_id string, updated_at timestamp, ingested_at timestamp, extra string, root string"


def table(spark, links):
    return spark.createDataFrame([(i, p, None, None, "x", "clash") for i, p in links], SCHEMA)


def brute(parents):
    out = {}
    for start in parents:
        path, here, seen = [start], start, {start: 0}
        while True:
            here = parents[here]
            if here is None:
                out[start] = (path[-1], len(path) - 1, tuple(reversed(path)), None, None)
                break
            if here in seen:
                ring = path[seen[here] :]
                out[start] = (None, None, None, min(ring), "on" if start in ring else "below")
                break
            seen[here] = len(path)
            path.append(here)
    return out


def solved(df, **k):
    return {r.id: (r.root, r.depth, tuple(r.path) if r.path is not None else None, r.cycle_id, r.place) for r in resolve_hierarchy(df, **k).collect()}


def scattered(n=140):
    name = lambda i: hashlib.md5(str(i).encode()).hexdigest()[:8]
    rnd = random.Random(3)
    parents = {name(i): name(i - 1) if i % 40 else None for i in range(n)}
    parents |= {name(n + i): name(n + (i + 1) % 30) for i in range(30)}
    parents |= {name(n + 30 + i): name(n + rnd.randrange(30 + i)) for i in range(30)}
    parents[name(9999)] = name(9999)
    return parents


def test_one_task_and_many_agree_with_brute_force(spark):
    parents = scattered()
    want = brute(parents)
    assert solved(table(spark, parents.items())) == want
    assert solved(table(spark, parents.items()), rows_per_task=60) == want


def light(df, **k):
    return {r.id: (r.root, r.depth, r.cycle_id, r.place) for r in resolve_roots(df, **k).collect()}


def test_roots_without_paths_agree_with_brute_force(spark):
    parents = scattered()
    want = {i: (v[0], v[1], v[3], v[4]) for i, v in brute(parents).items()}
    assert light(table(spark, parents.items())) == want
    assert light(table(spark, parents.items()), rows_per_task=60) == want
    rnd = random.Random(11)
    for _ in range(2):
        # Rings over many fragments with trees hanging from them.
        ring = [f"r{rnd.random():.6f}" for _ in range(45)]
        parents = dict(zip(ring, ring[1:] + ring[:1]))
        for k in range(80):
            parents[f"t{rnd.random():.6f}"] = rnd.choice(list(parents))
        want = {i: (v[0], v[1], v[3], v[4]) for i, v in brute(parents).items()}
        assert light(table(spark, parents.items()), rows_per_task=50) == want
    assert light(table(spark, [])) == {}


def test_deep_chains_cost_linear_memory():
    n = 200_000
    tracemalloc.start()
    rows = {f"{i:07d}": (f"{i - 1:07d}" if i else None, 1, f"{i:07d}", None) for i in range(n)}
    last = None
    for last in contract_light(rows):
        pass
    assert last[4:7] == ("root", "0000000", n - 1)
    first = next(iter(contract({k: (v[0], [], None) for k, v in rows.items()})))
    assert first[:3] == ("0000000", "root", "0000000")
    assert tracemalloc.get_traced_memory()[1] < 400_000_000
    tracemalloc.stop()


def test_descendants_are_counted_over_fragments(spark):
    parents = {k: v for k, v in scattered().items() if brute(scattered())[k][3] is None}
    resolved = resolve_hierarchy(table(spark, parents.items()))
    want = {i: sum(i in v[2][:-1] for v in brute(parents).values()) for i in parents}
    for rows_per_task in (1000, 50):
        assert {r.id: r.n_descendants for r in hierarchy_table(resolved, rows_per_task).collect()} == want


def test_dirty_parents_are_roots(spark):
    got = solved(table(spark, [("a", None), ("b", "  "), ("c", "　a "), ("d", "nowhere"), (None, "a")]))
    assert {i: (v[0], v[1]) for i, v in got.items()} == {"a": ("a", 0), "b": ("b", 0), "c": ("a", 1), "d": ("d", 0)}


def test_latest_row_counts_and_repeats_dont(spark):
    rows = [("a", None, "2026-01-01", "2026-01-01"), ("b", "a", "2026-01-01", "2026-01-02"), ("b", "c", None, "2026-01-03"), ("b", "a", "2026-01-01", "2026-01-02"), ("c", None, "2026-01-01", "2026-01-01")]
    df = spark.createDataFrame(rows, "id string, parent_id string, updated_at string, ingested_at string")
    assert solved(df)["b"][:2] == ("a", 1)


def test_empty_table(spark):
    assert resolve_hierarchy(table(spark, [])).collect() == []


def test_descendants_and_counts(spark):
    tree = resolve_hierarchy(table(spark, [("a", None), ("b", "a"), ("c", "b"), ("x", "y"), ("y", "x")]))
    assert {tuple(r) for r in descendants(tree).collect()} == {("a", "b", 1), ("a", "c", 2), ("b", "c", 1)}
    assert {r.id: r.n_descendants for r in hierarchy_table(tree).collect()} == {"a": 2, "b": 1, "c": 0, "x": None, "y": None}


def test_release_removes_what_the_operators_wrote(spark):
    import os

    from tessella import runtime

    resolve_hierarchy(table(spark, [("a", None), ("b", "a")])).collect()
    folders = [b.removeprefix("file://") for b in runtime._MADE]
    assert any(os.path.isdir(f) for f in folders)
    runtime.release(spark)
    assert not any(os.path.isdir(f) for f in folders) and not runtime._MADE
