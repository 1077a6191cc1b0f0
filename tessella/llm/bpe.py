"""Encoding of a whole corpus with a public byte-level BPE vocabulary.

Method: a rank queue with a hierarchical bitmap.  Positions of all pre-tokens
of a batch form linked lists in shared arrays.  A bucket per merge rank holds
the positions where that merge is possible; three levels of bitmaps over the
ranks give the next one by find-first-set.  All positions of the next rank are
merged at once, since merges in different pre-tokens do not touch each other
and a rank that is lowest over the batch is lowest in each pre-token holding
it.  Entries that an earlier merge made stale fail a comparison and are
skipped.  A pre-token of a million bytes costs no more a byte than a short one.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary files lie; a parameter of every operator here.
DEFAULT_FOLDER = "/opt/tokenizers"
DEFAULT_NAME = "byte_bpe_50k"
#: Characters of text that are pre-tokenised before their merges run.
BATCH_CHARS = 12_000_000


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level BPE files, to the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(other)}}


class Numbering(dict):
    """Numbers keys in the order they are first asked for."""

    def __missing__(self, key: str) -> int:
        value = self[key] = len(self)
        return value


class BytePairEncoder:
    """Encodes texts in bulk by the vocabulary in ``folder/name.json``, without special tokens."""

    def __init__(self, folder: str = DEFAULT_FOLDER, name: str = DEFAULT_NAME):
        with open(os.path.join(folder, f"{name}.json"), encoding="utf-8") as f:
            model = json.load(f)
        vocab = model["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.vocabulary: dict[str, int] = vocab
        symbols = byte_symbols()
        self.byte_id = np.zeros(256, np.int32)
        for s, b in symbols.items():
            self.byte_id[b] = vocab[s]
        self.left = np.array([vocab[a] for a, _ in merges], np.int32)
        self.right = np.array([vocab[b] for _, b in merges], np.int32)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        keys = (self.left.astype(np.int64) << 17) | self.right
        self.order = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.order]
        self.pattern = regex.compile(PATTERN)
        # Open addressing over the pairs: slots are probed together for a whole array.
        self.bits = 19
        self.slot_key = np.full(1 << self.bits, -1, np.int64)
        self.slot_rank = np.full(1 << self.bits, -1, np.int32)
        todo, shift = np.arange(len(keys)), 0
        at = self.slots(keys)
        while len(todo):
            free = self.slot_key[at[todo]] < 0
            first = np.unique(at[todo[free]], return_index=True)[1]
            put = todo[free][first]
            self.slot_key[at[put]], self.slot_rank[at[put]] = keys[put], put
            todo = np.setdiff1d(todo, put)
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            shift += 1
        self.probes = shift

    def text_of(self, ids: list[int]) -> str:
        """What ids stand for; bytes that are no UTF-8 are replaced."""
        if not hasattr(self, "bytes_of"):
            symbols = byte_symbols()
            self.bytes_of = {i: bytes(symbols[c] for c in s) for s, i in self.vocabulary.items() if all(c in symbols for c in s)}
        return b"".join(self.bytes_of[i] for i in ids).decode("utf-8", "replace")

    def slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, -1 where it is no merge."""
        keys = (left.astype(np.int64) << 17) | right
        at = self.slots(keys)
        out = np.full(len(keys), -1, np.int32)
        seen = self.slot_key[at]
        hit = seen == keys
        out[hit] = self.slot_rank[at[hit]]
        open_ = np.flatnonzero(~hit & (seen >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            seen = self.slot_key[at[open_]]
            hit = seen == keys[open_]
            out[open_[hit]] = self.slot_rank[at[open_[hit]]]
            open_ = open_[~hit & (seen >= 0)]
        return out

    def merge(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the byte strings in ``data`` that end at ``ends``; ids and the end of each."""
        size = len(data)
        tok = self.byte_id[data]
        nxt = np.arange(1, size + 1, dtype=np.int32)
        nxt[ends - 1] = -1
        prv = np.arange(-1, size - 1, dtype=np.int32)
        prv[np.concatenate(([0], ends[:-1]))] = -1
        inner = np.flatnonzero(nxt >= 0)
        rank = self.ranks(tok[inner], tok[inner + 1])
        buckets: dict[int, list[np.ndarray]] = {}
        top, middle, low = 0, [0] * (len(self.made) // 4096 + 1), [0] * (len(self.made) // 64 + 1)

        def push(where: np.ndarray, ranks: np.ndarray) -> None:
            nonlocal top
            order = np.argsort(ranks, kind="stable")
            ranks, where = ranks[order], where[order]
            starts = np.flatnonzero(np.concatenate(([True], ranks[1:] != ranks[:-1])))
            stops = np.append(starts[1:], len(ranks)).tolist()
            for r, a, b in zip(ranks[starts].tolist(), starts.tolist(), stops):
                held = buckets.get(r)
                if held is not None:
                    held.append(where[a:b])
                else:
                    buckets[r] = [where[a:b]]
                    low[r >> 6] |= 1 << (r & 63)
                    middle[r >> 12] |= 1 << (r >> 6 & 63)
                    top |= 1 << (r >> 12)

        can = rank >= 0
        if can.any():
            push(inner[can].astype(np.int32), rank[can])
        while top:
            a = (top & -top).bit_length() - 1
            b = a << 6 | ((middle[a] & -middle[a]).bit_length() - 1)
            r = b << 6 | ((low[b] & -low[b]).bit_length() - 1)
            low[b] &= low[b] - 1
            if not low[b]:
                middle[a] &= middle[a] - 1
                if not middle[a]:
                    top &= top - 1
            held = buckets.pop(r)
            p = held[0] if len(held) == 1 else np.unique(np.concatenate(held))
            left, right, new = self.left[r], self.right[r], self.made[r]
            q = nxt[p]
            fit = (tok[p] == left) & (q >= 0)
            fit &= tok[q] == right
            if not fit.all():
                p, q = p[fit], q[fit]
                if not len(p):
                    continue
            if left == right and len(p) > 1:
                # Of overlapping places the leftmost merges, then every other one of the run.
                chained = np.concatenate(([False], q[:-1] == p[1:]))
                index = np.arange(len(p))
                start = np.maximum.accumulate(np.where(chained, 0, index))
                keep = (index - start) % 2 == 0
                p, q = p[keep], q[keep]
            beyond = nxt[q]
            tok[p] = new
            tok[q] = -1
            nxt[p] = beyond
            more = beyond >= 0
            prv[beyond[more]] = p[more]
            before = prv[p]
            has = before >= 0
            where = np.concatenate((before[has], p[more]))
            if not len(where):
                continue
            rank = self.ranks(tok[where], tok[nxt[where]])
            can = rank >= 0
            if can.any():
                push(where[can], rank[can])
        alive = tok >= 0
        return tok[alive], np.cumsum(alive)[ends - 1]

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and offsets into them; null and empty give none."""
        known = Numbering()
        occurs: list[np.ndarray] = []
        counts = np.zeros(len(texts), np.int64)
        find = self.pattern.findall
        for i, t in enumerate(texts):
            if t:
                found = find(t)
                counts[i] = len(found)
                occurs.append(np.array(list(map(known.__getitem__, found)), np.int32))
        offsets = np.zeros(len(texts) + 1, np.int64)
        if not known:
            return np.zeros(0, np.int32), offsets
        data = [x.encode("utf-8", "surrogatepass") for x in known]
        ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))
        ids, stop = self.merge(np.frombuffer(b"".join(data), np.uint8), ends)
        size = np.diff(stop, prepend=0)
        begin = stop - size
        all_ = np.concatenate(occurs)
        lens = size[all_]
        total = np.cumsum(lens)
        flat = ids[np.arange(total[-1]) - np.repeat(total - lens, lens) + np.repeat(begin[all_], lens)]
        at = np.concatenate(([0], total))
        offsets[1:] = at[np.cumsum(counts)]
        return flat, offsets


#: Fixed value: the pre-token pattern of this public vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encoder(folder: str, name: str) -> BytePairEncoder:
    """The encoder, read once per Python worker."""
    cache = globals().setdefault("_ENCODERS", {})
    if (folder, name) not in cache:
        cache[folder, name] = BytePairEncoder(folder, name)
    return cache[folder, name]


def encode_corpus(df: DataFrame, key: str, text: str, folder: str = DEFAULT_FOLDER, name: str = DEFAULT_NAME, count_only: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, ids) of every row, or (key, n_tokens) with ``count_only``.

    ``ids`` are those of the vocabulary without special tokens: text that looks
    like one is ordinary text.  Null and empty texts get an empty list.  One
    row comes out for each that goes in; the plan has no shuffle, and texts of
    any length are encoded whole.  String columns named in ``keep`` come along.
    """
    source = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"), *(F.col(c).cast("string").alias(f"kept_{i}") for i, c in enumerate(keep)))
    kind = pa.int32() if count_only else pa.list_(pa.int32())

    names = ["key", "ids", *(f"kept_{i}" for i in range(len(keep)))]
    more = "".join(f", kept_{i} string" for i in range(len(keep)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(folder, name)
        keys: list = []
        texts: list = []
        others: list[list] = [[] for _ in keep]
        held = 0

        def flush() -> pa.RecordBatch:
            flat, offsets = tool.encode_batch(texts)
            if count_only:
                out = pa.array(np.diff(offsets).astype(np.int32))
            else:
                out = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), out.cast(kind), *(pa.array(o, pa.string()) for o in others)], names=names)

        for batch in batches:
            for k, t, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                keys.append(k)
                texts.append(t)
                for o, x in zip(others, rest):
                    o.append(x)
                held += len(t or "")
                if held > BATCH_CHARS:
                    yield flush()
                    keys, texts, others, held = [], [], [[] for _ in keep], 0
        if keys:
            yield flush()

    out = source.mapInArrow(run, ("key bigint, ids int" if count_only else "key bigint, ids array<int>") + more)
    return out.select(F.col("key").alias(key), F.col("ids").alias("n_tokens" if count_only else "ids"), *(F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)))


def decode_corpus(df: DataFrame, key: str, ids: str, folder: str = DEFAULT_FOLDER, name: str = DEFAULT_NAME) -> DataFrame:
    """(key, text): the texts that lists of ids stand for; null and empty lists give an empty text."""
    source = df.select(F.col(key).alias("key"), F.col(ids).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(folder, name)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([tool.text_of(x or []) for x in batch.column(1).to_pylist()], pa.string())], names=["key", "text"])

    return source.mapInArrow(run, f"key {source.schema['key'].dataType.simpleString()}, text string").withColumnRenamed("key", key)
