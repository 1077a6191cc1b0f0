import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessella.llm import nearcopies as n


def grams(t):
    return {t[i : i + 5] for i in range(len(t) - 4)}


def corpus():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(3, 9)))
    texts = {}
    for i in range(60):
        words = [word() for _ in range(30)]
        texts[f"k{i:03d}"] = " ".join(words)
        for j in range(i % 4):
            changed = list(words)
            for _ in range(rnd.randrange(0, 6)):
                changed[rnd.randrange(30)] = word()
            texts[f"k{i:03d}-{j}"] = " ".join(changed)
    return texts


def test_pairs_and_groups_equal_brute_force(spark):
    texts = corpus() | {"short": "too short", "copy": corpus()["k001"].upper() + " \n　"}
    data = [(k, t, "x") for k, t in texts.items()] + [("k001", texts["k001"], "x"), ("none", None, "x"), (None, texts["k002"], "x"), ("empty", "", "x")]
    df = spark.createDataFrame(data, "id string, t string, item_key string")
    items = n.near_items(df, "q", F.col("id"), F.col("t")).unionByName(n.near_items(df.where("id = 'k001'"), "other", F.col("id"), F.col("t")))
    flat = {k: "".join(t.lower().split()) for k, t in texts.items()}
    flat = {k: grams(t) for k, t in flat.items() if len(t) >= 40}
    want = {("q", a, b) for a in flat for b in flat if a < b and len(flat[a] & flat[b]) / len(flat[a] | flat[b]) >= 0.6}
    got = [tuple(r) for r in n.near_pairs(items).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 30
    rows = {(r.item_kind, r.item_key): (r.group_key, r.n_links) for r in n.near_groups(items).collect()}
    assert rows["other", "k001"] == ("k001", 0)
    for k in flat:
        assert rows["q", k][1] == sum(k in (a, b) for _, a, b in want)
    assert all(rows["q", a][0] == rows["q", b][0] for _, a, b in want)


def test_empty(spark):
    df = spark.createDataFrame([], "id string, t string")
    items = n.near_items(df, "q", F.col("id"), F.col("t"))
    assert n.near_pairs(items).collect() == [] and n.near_groups(items).collect() == []


def test_trees_return_what_all_comparisons_return():
    rng = np.random.default_rng(3)
    points = rng.integers(0, 2**63, (400, n.WORDS), dtype=np.uint64)
    points[200:] = points[:200]
    points[200:, 0] ^= rng.integers(0, 2**20, 200, dtype=np.uint64)
    for reach in (5, 60, 95):
        distance = n.hamming(points[:, None], points[None])
        i, j = np.nonzero(np.triu(distance <= reach, 1))
        a, b = n.close_pairs(points, reach)
        assert set(zip(i, j)) == set(zip(a, b)) and len(a) == len(i)
        i, j = np.nonzero(distance[:150, 150:] <= reach)
        a, b = n.cross_pairs(points[:150], points[150:], reach)
        assert set(zip(i, j)) == set(zip(a, b))


def test_crowded_shards_over_any_cut_of_the_stream():
    rnd = random.Random(5)
    for _ in range(100):
        size = rnd.randrange(0, 50)
        shard = sorted(rnd.randrange(10) for _ in range(size))
        cuts = sorted(rnd.randrange(size + 1) for _ in range(4)) if size else []
        batches = [pa.RecordBatch.from_arrays([pa.array(shard[x:y], pa.int64()), pa.array(range(x, y), pa.int64())], names=["s", "c"]) for x, y in zip([0, *cuts], [*cuts, size])]
        got = sorted((r["cid"], r["shard"], r["block"]) for b in n._crowded(iter(batches), 3) for r in b.to_pylist())
        places = {s: [i for i, v in enumerate(shard) if v == s] for s in set(shard)}
        assert got == sorted((i, s, p // 3) for s, at in places.items() if len(at) > 1 for p, i in enumerate(at))


def test_a_hot_shard_is_searched_block_against_block(spark):
    # Every text shares most of its words, so shards hold nearly all of them.
    rnd = random.Random(6)
    base = " ".join(f"shared{i}" for i in range(40))
    df = spark.createDataFrame([(f"k{i:02d}", f"{base} own{i} {rnd.random()}") for i in range(40)], "id string, t string")
    got = n.near_pairs(n.near_items(df, "q", F.col("id"), F.col("t")), block=8).count()
    assert got == 40 * 39 // 2


def test_copies_of_a_hot_text_are_paired_in_blocks(spark):
    from itertools import combinations

    from tessella.llm.nearcopies import copy_pairs

    rows = [("q", 1, f"k{i:02d}") for i in range(23)] + [("q", 2, "a"), ("q", 2, "b"), ("q", 3, "alone"), ("c", 1, "x")]
    members = spark.createDataFrame(rows, "item_kind string, cid bigint, item_key string")
    want = {("q", *p) for p in combinations([f"k{i:02d}" for i in range(23)], 2)} | {("q", "a", "b")}
    got = [tuple(r) for r in copy_pairs(members, block=4).collect()]
    assert set(got) == want and len(got) == len(want)
