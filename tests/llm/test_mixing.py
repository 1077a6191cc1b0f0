import os
import random

import pytest

from tessella.llm.bpe import DEFAULT_FOLDER
from tessella.llm.mixing import fly, land, mixture


def test_the_flight_keeps_both_totals_and_decides_all_but_two():
    rnd = random.Random(8)
    for n in (1, 2, 3, 50, 500):
        sizes = [rnd.randrange(1, 1000) for _ in range(n)]
        chances = [rnd.random() for _ in range(n)]
        out = fly(sizes, chances, random.Random(1))
        assert sum(0 < p < 1 for p in out) <= 2
        assert abs(sum(out) - sum(chances)) < 1e-6
        assert abs(sum(s * p for s, p in zip(sizes, out)) - sum(s * p for s, p in zip(sizes, chances))) < 1e-4 * sum(sizes)


def test_chances_are_kept_in_expectation():
    taken = [0] * 6
    for seed in range(3000):
        for k, p in enumerate(fly([5, 1, 9, 4, 4, 7], [0.5] * 6, random.Random(seed))):
            taken[k] += p
    assert all(abs(t / 3000 - 0.5) < 0.04 for t in taken)


def test_landing():
    assert sorted(land([3, 3], [0.5, 0.5])) == [0.0, 1.0]
    assert land([], []) == []
    out = land([10, 100, 3, 7], [1.0, 0.0, 0.4, 0.0])
    assert set(out) <= {0.0, 1.0}


@pytest.mark.skipif(not os.path.exists(f"{DEFAULT_FOLDER}/byte_bpe_50k.json"), reason="vocabulary not here")
def test_mixture(spark):
    rnd = random.Random(9)
    text = lambda: " ".join(rnd.choice(["alpha", "beta", "gamma"]) for _ in range(rnd.randrange(5, 60)))
    docs = [(i, text(), ["Big-One", " big_one", "BIG ONE"][i % 3]) for i in range(240)] + [(1000 + i, text(), "small") for i in range(40)]
    docs += [(2000, "", "small"), (2001, None, "small"), (2002, "x y", None), (2003, "x y", "unlisted"), (5, docs[5][1], docs[5][2])]
    documents = spark.createDataFrame([(*d, 1.0) for d in docs], "doc_id bigint, text string, source string, repeats double")
    targets = spark.createDataFrame([("big_one", 0.5, 1), ("small", 0.4, 3), ("absent", 0.1, 5)], "source string, target_share double, max_repeats int")
    for block in (20_000, 20):
        mixed, report = mixture(documents, targets, block=block)
        rows = {r.source: r for r in report.collect()}
        assert rows["absent"].mixed_tokens == 0 and rows["unlisted"].mixed_tokens == 0 and rows[None].mixed_tokens == 0
        assert abs(rows["big_one"].reached_share - 0.5 / 0.9) < 0.01 and abs(rows["small"].reached_share - 0.4 / 0.9) < 0.01
        used = mixed.collect()
        assert len({r.doc_id for r in used}) == len(used)
        assert all(1 <= r.repeats <= {"big_one": 1, "small": 3}[r.source] for r in used)
    again = sorted(tuple(r) for r in mixture(documents.repartition(3), targets, block=20)[0].collect())
    assert again == sorted(tuple(r) for r in used)
    assert mixture(documents.limit(0), targets)[0].collect() == []
    assert mixture(documents, targets.limit(0))[0].collect() == []
