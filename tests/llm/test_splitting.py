import random
import re

from tessella.llm.splitting import Boundaries, cut_kind, pieces_of, split_texts, text_cuts


def check(text, limit=420, overlap=40):
    spans = pieces_of(text, limit, overlap)
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    assert all(b - a <= limit for a, b in spans)
    assert all(nxt[0] == prev[1] - overlap and nxt[1] > prev[1] for prev, nxt in zip(spans, spans[1:]))
    return spans


def test_random_texts_hold_all_limits():
    rnd = random.Random(1)
    for _ in range(300):
        text = "".join(rnd.choice("ab字 ，。.\n") if rnd.random() < 0.2 else "x" for _ in range(rnd.randrange(1, 4000)))
        check(text)
        check(text, 50, 10)


def test_cuts_lie_at_boundaries_where_there_are_any():
    text = "".join(f"第{i}句话说的是一件小事，没有别的。" for i in range(200))
    at = set(Boundaries(text).at)
    assert all(b in at for _, b in check(text)[:-1])
    # The least number of pieces is enough here, and they are of like length.
    spans = check(text)
    assert len(spans) == -(-(len(text) - 40) // 380)
    assert min(b - a for a, b in spans) > 0.7 * max(b - a for a, b in spans)


def test_a_piece_is_added_for_an_early_boundary():
    text = "a" * 300 + "。" + "b" * 379 + "。" + "c" * 100
    assert [b for _, b in check(text)] == [301, 681, 781]


def test_unbroken_text_is_cut_hard():
    spans = check("x" * 5000)
    assert max(b - a for a, b in spans) - min(b - a for a, b in spans) <= 41


def longest_span(text):
    return max(map(len, re.split(r"\n|[。！？；]|[.!?;](?=\s)", text)))


def test_the_kind_of_cut_follows_from_the_piece_ends():
    rnd = random.Random(2)
    for _ in range(600):
        text = "".join(rnd.choice("ab字 ，。.\n”\t?!：") if rnd.random() < 0.02 else "x" for _ in range(rnd.randrange(421, 3000)))
        assert cut_kind(text, 420, 40)[0] == ("hard" if longest_span(text) > 420 else "natural")


def test_strengths():
    seen = Boundaries("a，b。”c\n \nd. e！？f")
    assert list(zip(seen.at, seen.strength)) == [(2, 1), (5, 2), (7, 3), (9, 4), (12, 2), (15, 2)]
    assert Boundaries("").at == []


def test_operator_with_nulls_repeats_clashes_and_astral_characters(spark):
    long = "😀" * 421
    rows = [("k1", long, "x", 1), ("k1", long, "y", 2), ("k2", "short", "x", 1), ("k3", None, "x", 1), ("k4", "", "x", 1), ("k5", "a。" * 211, "x", 1)]
    df = spark.createDataFrame(rows, "doc_key string, raw_text string, item_key string, cut int")
    assert {(r.item_key, r.cut, r.n_pieces) for r in text_cuts(df, "doc_key", "raw_text").collect()} == {("k1", "hard", 2), ("k5", "natural", 2)}
    got = sorted(split_texts(df, "doc_key", "raw_text").where("item_key = 'k1'").collect(), key=lambda r: r.piece_no)
    assert len(got) == 2 and got[0].piece[-40:] == got[1].piece[:40] and got[1].start == got[0].length - 40
    assert text_cuts(df.limit(0), "doc_key", "raw_text").collect() == [] and split_texts(df.limit(0), "doc_key", "raw_text").collect() == []
