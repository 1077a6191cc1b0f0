import os
import random

import numpy as np
import pytest

from tessella.llm.bpe import DEFAULT_FOLDER, BytePairEncoder, encode_corpus

pytestmark = pytest.mark.skipif(not os.path.exists(f"{DEFAULT_FOLDER}/byte_bpe_50k.json"), reason="vocabulary not here")
ODD = ["", " ", "<|endoftext|>", "aaaaaaaaaaaaaaaaa", "a" * 5000, "\n\n \t x", "I'll don't we've", "é́ 한글 👩🏽‍💻 龘", "x" * 3 + "　" + "１２３", "的" * 3000, "\x00\x7f﻿"]


def reference():
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(f"{DEFAULT_FOLDER}/byte_bpe_50k.json")
    tool.encode_special_tokens = True
    return tool


def test_ids_equal_the_public_library():
    rnd = random.Random(7)
    texts = ODD + ["".join(rnd.choice("ab cd'sé的是,.\n0 1😀") for _ in range(rnd.randrange(80))) for _ in range(400)]
    flat, offsets = BytePairEncoder().encode_batch(texts)
    want = reference().encode_batch(texts, add_special_tokens=False)
    assert [flat[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [w.ids for w in want]


def test_nothing_to_encode():
    flat, offsets = BytePairEncoder().encode_batch([None, ""])
    assert len(flat) == 0 and np.array_equal(offsets, [0, 0, 0])


def test_operator(spark):
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate([*ODD, None])], "doc_id bigint, text string, ids string, key int")
    got = {r.doc_id: r.ids for r in encode_corpus(df, "doc_id", "text").collect()}
    assert got == {i: reference().encode(t or "", add_special_tokens=False).ids for i, t in enumerate([*ODD, None])}
    counts = {r.doc_id: r.n_tokens for r in encode_corpus(df, "doc_id", "text", count_only=True).collect()}
    assert counts == {i: len(v) for i, v in got.items()}
    assert encode_corpus(df.limit(0), "doc_id", "text").collect() == []


def test_ids_decode_to_the_text(spark):
    from tessella.llm.bpe import decode_corpus, encode_corpus

    texts = ["", None, "for (int i = 0;)", "索引树 👩🏽‍💻\n\t", "<|endoftext|>", "x" * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in decode_corpus(encode_corpus(df, "doc_id", "text"), "doc_id", "ids").collect()}
    assert got == {i: t or "" for i, t in enumerate(texts)}
