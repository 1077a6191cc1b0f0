"""Near-duplicate records with small edits.

Method: fingerprints in Hamming space, vantage-point trees with triangle
bounds, overlapping shards, exact check of what the trees return.

A fingerprint has a bit per min-hash of the text's character substrings, so the
expected Hamming distance of two texts is half the share of substrings that
differ.  At a similarity of 0.6 the search radius is close to the distance of
unrelated texts, and a vantage-point tree over the whole collection could prune
nothing (see the README for figures).  So shards come first: every text lies in
one shard per band of min-hashes, a pair above the threshold shares one of its
shards almost surely, and within a shard the tree decides.

Exact copies are one class from the start and are expanded last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import squeeze
from tessella.llm.components import components
from tessella.runtime import Scratch

BANDS, ROWS = 50, 4
HASHES = BANDS * ROWS
#: Bytes of a fingerprint: a bit per min-hash, filled up to whole 64-bit words.
WORDS = -(-HASHES // 64)
#: Texts a tree is built over at most; larger shards are searched block against block.
BLOCK = 4096
LEAF = 24


def radius(threshold: float, sigmas: float = 4.5) -> int:
    """Hamming distance that a pair at the threshold exceeds once in about 300,000 times."""
    p = (1 - threshold) / 2
    return int(np.ceil(HASHES * p + sigmas * np.sqrt(HASHES * p * (1 - p))))


def multipliers() -> tuple[np.ndarray, np.ndarray]:
    """The min-hash functions: odd factors and offsets from a fixed seed."""
    rng = np.random.Generator(np.random.PCG64(7))
    return rng.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1), rng.integers(0, 2**32, HASHES, dtype=np.uint32)


def shingle_hashes(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """A 32-bit hash of every substring of ``width`` characters, and where each text's begin."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    end = np.cumsum(size)
    rolled = np.zeros(len(points) - width + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            rolled *= np.uint64(0x100000001B3)
            rolled ^= points[i : len(points) - width + 1 + i].astype(np.uint64)
            rolled *= np.uint64(0x9E3779B97F4A7C15)
            rolled ^= rolled >> np.uint64(29)
    inside = np.ones(len(points), bool)
    for i in range(1, width):
        inside[end - i] = False
    kept = inside[: len(rolled)]
    return (rolled[kept] >> np.uint64(32)).astype(np.uint32), np.concatenate(([0], np.cumsum(size - width + 1)[:-1]))


def min_hashes(texts: list[str], width: int) -> np.ndarray:
    """(texts, HASHES) of min-hashes; every text has at least ``width`` characters."""
    factor, offset = multipliers()
    out = np.empty((HASHES, len(texts)), np.uint32)
    # Blocks small enough for the processor's cache, never cutting a text.
    at = 0
    while at < len(texts):
        stop, total = at, 0
        while stop < len(texts) and (stop == at or total + len(texts[stop]) <= 60_000):
            total += len(texts[stop])
            stop += 1
        hashes, begin = shingle_hashes(texts[at:stop], width)
        mixed = np.empty_like(hashes)
        for k in range(HASHES):
            np.multiply(hashes, factor[k], out=mixed)
            np.add(mixed, offset[k], out=mixed)
            out[k, at:stop] = np.minimum.reduceat(mixed, begin)
        at = stop
    return out.T


def fingerprints(mins: np.ndarray) -> np.ndarray:
    """(texts, WORDS) of 64-bit words with one bit of each min-hash."""
    with np.errstate(over="ignore"):
        bit = ((mins * np.uint32(0x9E3779B1)) >> np.uint32(31)).astype(np.uint8)
    padded = np.zeros((len(mins), WORDS * 64), np.uint8)
    padded[:, :HASHES] = bit
    return np.packbits(padded, axis=1).view(np.uint64)


def band_keys(mins: np.ndarray) -> np.ndarray:
    """(texts, BANDS) of 32-bit hashes of each band's min-hashes."""
    parts = mins.reshape(len(mins), BANDS, ROWS).astype(np.uint64)
    key = np.zeros((len(mins), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for r in range(ROWS):
            key = (key ^ parts[:, :, r]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(31)
    return (key >> np.uint64(32)).astype(np.uint32).view(np.int32)


# ------------------------------------------------------- vantage-point trees


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int32)


def tree_of(points: np.ndarray, members: np.ndarray) -> tuple:
    """A vantage-point tree: ('leaf', members) or (vantage, inner radius, outer radius, inner, outer)."""
    if len(members) <= LEAF:
        return ("leaf", members)
    distance = hamming(points[members], points[members[0]])
    middle = int(np.median(distance))
    inner = distance <= middle
    if inner.all():
        inner = distance < middle
        if not inner.any():
            return ("leaf", members)
    return (members[0], int(distance[inner].max()), int(distance[~inner].min()), tree_of(points, members[inner]), tree_of(points, members[~inner]))


def search(tree: tuple, points: np.ndarray, queries: np.ndarray, wanted: np.ndarray, reach: int, found: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Adds (query, point) within ``reach`` for the queries ``wanted``; whole sets of queries go down together."""
    if not len(wanted):
        return
    if tree[0] == "leaf":
        near = hamming(queries[wanted][:, None, :], points[tree[1]][None, :, :]) <= reach
        q, p = np.nonzero(near)
        found.append((wanted[q], tree[1][p]))
        return
    vantage, inner_most, outer_least, inner, outer = tree
    distance = hamming(queries[wanted], points[vantage])
    # By the triangle inequality a point within reach of a query differs from it by at most reach in distance to the vantage point.
    search(inner, points, queries, wanted[distance - reach <= inner_most], reach, found)
    search(outer, points, queries, wanted[distance + reach >= outer_least], reach, found)


def close_pairs(points: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs i < j of ``points`` within ``reach``."""
    if len(points) == 2:
        near = hamming(points[0], points[1]) <= reach
        return (np.array([0]), np.array([1])) if near else (np.zeros(0, int), np.zeros(0, int))
    found: list = []
    search(tree_of(points, np.arange(len(points))), points, points, np.arange(len(points)), reach, found)
    i, j = (np.concatenate(x) for x in zip(*found))
    keep = i < j
    return i[keep], j[keep]


def cross_pairs(left: np.ndarray, right: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with left[i] within ``reach`` of right[j]."""
    found: list = []
    search(tree_of(right, np.arange(len(right))), right, left, np.arange(len(left)), reach, found)
    return tuple(np.concatenate(x) for x in zip(*found))


# ------------------------------------------------------------------ the plan


def near_items(df: DataFrame, kind: str, key: Column, text: Column, least: int = 40) -> DataFrame:
    """(item_kind, item_key, text): squeezed texts of at least ``least`` characters."""
    rows = df.select(F.lit(kind).alias("item_kind"), key.cast("string").alias("item_key"), squeeze(text).alias("text"))
    return rows.where(F.col("item_key").isNotNull() & (F.char_length("text") >= least))


def class_of() -> Column:
    """The number of a text's class: rows of one kind with one text share it."""
    return F.xxhash64("item_kind", "text")


def _sketch(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        mins = min_hashes(batch.column(3).to_pylist(), width)
        prints = fingerprints(mins)
        bands = band_keys(mins)
        offsets = pa.array(np.arange(0, (batch.num_rows + 1) * BANDS, BANDS, dtype=np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.array(bands.ravel()))
        raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(WORDS * 8), batch.num_rows, [None, pa.py_buffer(prints.tobytes())]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], raw, lists], names=["item_kind", "item_key", "cid", "print", "bands"])


def _crowded(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by shard those that share it with another, numbered in blocks."""
    last_shard, last_cid, run = None, None, 0  # the row held back and its place in its run
    for batch in batches:
        shard, cid = (c.to_numpy() for c in batch.columns)
        if not len(shard):
            continue
        start = np.concatenate(([last_shard is None or shard[0] != last_shard], shard[1:] != shard[:-1]))
        index = np.arange(len(shard))
        first = np.maximum.accumulate(np.where(start, index, -1))
        place = np.where(first >= 0, index - first, index + run + 1)
        follows = np.concatenate((~start[1:], [False]))
        keep = ~start | follows
        keep[-1] = False
        out = [shard[keep], cid[keep], (place[keep] // block).astype(np.int32)]
        if last_shard is not None and (not start[0] or run > 0):
            out = [np.concatenate(([v], o)) for v, o in zip((last_shard, last_cid, run // block), out)]
        last_shard, last_cid, run = shard[-1], cid[-1], int(place[-1])
        if len(out[0]):
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32())], names=["shard", "cid", "block"])
    if last_shard is not None and run > 0:
        yield pa.RecordBatch.from_arrays([pa.array([last_shard], pa.int64()), pa.array([last_cid], pa.int64()), pa.array([run // block], pa.int32())], names=["shard", "cid", "block"])


def _tree_pairs(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
    """Pairs of classes from rows (task, shard, side, cid, print) sorted by shard and task."""
    held: list[tuple[np.ndarray, ...]] = []

    def solve(rows: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray]:
        """All runs of the rows at once: the small ones vectorised by size, the others by a tree each."""
        shard, task, side, cid, prints = (np.concatenate(x) for x in zip(*rows))
        start = np.flatnonzero(np.concatenate(([True], (shard[1:] != shard[:-1]) | (task[1:] != task[:-1]))))
        size = np.diff(np.append(start, len(shard)))
        left, right = [], []
        pairs = start[size == 2]
        if len(pairs):
            near = (hamming(prints[pairs], prints[pairs + 1]) <= reach) & (cid[pairs] != cid[pairs + 1])
            left.append(cid[pairs[near]])
            right.append(cid[pairs[near] + 1])
        for s, n in zip(start[size > 2].tolist(), size[size > 2].tolist()):
            sides = side[s : s + n]
            ids, marks = cid[s : s + n], prints[s : s + n]
            if sides.any():
                a, b = np.flatnonzero(sides == 1), np.flatnonzero(sides == 2)
                if not len(a) or not len(b):
                    continue
                i, j = cross_pairs(marks[a], marks[b], reach)
                i, j = a[i], b[j]
            else:
                i, j = close_pairs(marks, reach)
            left.append(ids[i])
            right.append(ids[j])
        if not left:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = np.concatenate(left), np.concatenate(right)
        a, b = np.minimum(a, b), np.maximum(a, b)
        both = np.unique(np.stack((a, b), axis=1)[a != b], axis=0)
        return both[:, 0], both[:, 1]

    def emit(rows):
        a, b = solve(rows)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        shard, task, side, cid = (batch.column(i).to_numpy() for i in range(4))
        raw = b"".join(batch.column(4).to_pylist())
        prints = np.frombuffer(raw, np.uint64).reshape(-1, WORDS)
        # The last run may go on in the next batch; it is held back.
        same = (shard == shard[-1]) & (task == task[-1])
        cut = len(same) if same.all() else int(np.flatnonzero(~same)[-1]) + 1
        whole = (shard, task, side, cid, prints)
        if same.all():
            if held and (held[-1][0][-1] != shard[-1] or held[-1][1][-1] != task[-1]):
                yield emit(held)
                held = []
            held.append(whole)
            continue
        held.append(tuple(x[:cut] for x in whole))
        yield emit(held)
        held = [tuple(x[cut:] for x in whole)]
    if held:
        yield emit(held)


def _similarity(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Exact Jaccard similarity of the texts of each pair."""
    for batch in batches:
        known: dict[int, set[str]] = {}
        ids_a, ids_b, texts_a, texts_b = (c.to_pylist() for c in batch.columns)

        def grams(i: int, t: str) -> set[str]:
            if i not in known:
                if len(known) > 64:
                    known.clear()
                known[i] = {t[k : k + width] for k in range(len(t) - width + 1)}
            return known[i]

        out = []
        for a, b, x, y in zip(ids_a, ids_b, texts_a, texts_b):
            s, t = grams(a, x), grams(b, y)
            shared = len(s & t)
            out.append(shared / (len(s) + len(t) - shared))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], names=["a", "b", "similarity"])


def near_classes(items: DataFrame, scratch: Scratch, threshold: float = 0.6, width: int = 5, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Members (item_kind, cid, item_key) and pairs (a, b, similarity) of different classes at or above the threshold.

    ``items`` are those of ``near_items``.  Only texts in a candidate pair are
    shuffled; fingerprints and shard numbers travel instead of the others.
    """
    reach = radius(threshold)
    coded = items.select("item_kind", "item_key", class_of().alias("cid"), "text")
    sketch = coded.mapInArrow(lambda it: _sketch(it, width), "item_kind string, item_key string, cid bigint, print binary, bands array<int>")
    sketch = scratch.write(sketch, "sketches")
    members = scratch.write(sketch.select("item_kind", "cid", "item_key").distinct(), "members")
    # One representative row of each class goes into the shards.
    least = members.groupBy("cid").agg(F.min("item_key").alias("item_key"))
    classes = sketch.join(least, ["cid", "item_key"], "left_semi").select("item_kind", "cid", "print", "bands").dropDuplicates(["cid"])
    classes = scratch.write(classes, "classes")
    scratch.drop("sketches")
    # Shards are of one kind: only its own texts may be copies of a text.
    rows = classes.select("item_kind", "cid", F.posexplode("bands").alias("band", "low")).select(F.xxhash64("item_kind", "band", "low").alias("shard"), "cid")
    crowded = rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(lambda it: _crowded(it, block), "shard bigint, cid bigint, block int")
    crowded = scratch.write(crowded, "crowded")
    # A shard of several blocks is searched block against block, each in a task of its own.
    blocks = crowded.where("block > 0").groupBy("shard").agg(F.max("block").alias("last"))
    spread = crowded.join(blocks, "shard", "left")
    task = F.when(F.col("last").isNull(), F.array(F.struct(F.lit(0).alias("task"), F.lit(0).alias("side")))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("last")),
            lambda o: F.struct((F.least(o, F.col("block")) * (F.col("last") + 1) + F.greatest(o, F.col("block"))).cast("int").alias("task"), F.when(o == F.col("block"), 0).when(F.col("block") < o, 1).otherwise(2).alias("side")),
        )
    )
    spread = spread.select("shard", "cid", F.inline(task))
    placed = spread.join(classes.select("cid", "print"), "cid").select("shard", "task", "side", "cid", "print")
    placed = placed.repartition("shard", "task").sortWithinPartitions("shard", "task")
    pairs = placed.mapInArrow(lambda it: _tree_pairs(it, reach), "a bigint, b bigint").distinct()
    pairs = scratch.write(pairs, "pairs")
    scratch.drop("crowded")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    texts = coded.select("item_kind", "cid", "text").join(needed, "cid", "left_semi").dropDuplicates(["cid"])
    texts = scratch.write(texts, "texts")
    side = lambda c: texts.select("item_kind", F.col("cid").alias(c), F.col("text").alias(f"text_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), ["b", "item_kind"]).select("a", "b", "text_a", "text_b")
    checked = both.mapInArrow(lambda it: _similarity(it, width), "a bigint, b bigint, similarity double").where(F.col("similarity") >= threshold)
    return members, scratch.write(checked, "checked")


def copy_pairs(members: DataFrame, block: int = 2_000) -> DataFrame:
    """(item_kind, key_a, key_b): every pair of members of one class.

    A class of many members is paired block against block, so that a text that
    a third of all rows share is spread over as many tasks as its pairs need.
    """
    sizes = members.groupBy("item_kind", "cid").agg(F.count("*").alias("n")).where("n > 1").select("item_kind", "cid", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    placed = members.join(sizes, ["item_kind", "cid"]).withColumn("own", F.pmod(F.xxhash64("item_key"), F.col("blocks")).cast("int"))
    low = placed.select("item_kind", "cid", F.col("own").alias("low"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("high"), F.col("item_key").alias("x"))
    high = placed.select("item_kind", "cid", F.explode(F.sequence(F.lit(0), "own")).alias("low"), F.col("own").alias("high"), F.col("item_key").alias("y"))
    both = low.join(high, ["item_kind", "cid", "low", "high"]).where("low < high OR x < y")
    return both.select("item_kind", F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b"))


def near_pairs(items: DataFrame, threshold: float = 0.6, width: int = 5, block: int = BLOCK) -> DataFrame:
    """(item_kind, key_a, key_b): every pair of keys of one kind at or above the threshold, key_a < key_b."""
    scratch = Scratch(items.sparkSession, "near")
    members, pairs = near_classes(items, scratch, threshold, width, block)
    one = lambda c, k: members.select("item_kind", F.col("cid").alias(c), F.col("item_key").alias(k))
    copies = copy_pairs(members)
    across = pairs.select("a", "b").join(one("a", "x"), "a").join(one("b", "y").drop("item_kind"), "b")
    return copies.unionByName(across.select("item_kind", F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b")))


def near_groups(items: DataFrame, threshold: float = 0.6, width: int = 5, block: int = BLOCK) -> DataFrame:
    """(item_kind, item_key, group_key, n_links): every record with its group and its number of partners.

    Groups are the components of the pairs; a record without partners is its
    own group.  Copies are counted through their class, never paired out.
    """
    scratch = Scratch(items.sparkSession, "near")
    members, pairs = near_classes(items, scratch, threshold, width, block)
    group = components(pairs, "a", "b").select(F.col("vertex").alias("cid"), F.col("group_id").alias("root"))
    sizes = members.groupBy("cid").agg(F.count("*").alias("n"))
    around = pairs.select(F.col("a").alias("cid"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("cid"), F.col("a").alias("other")))
    links = around.join(sizes.select(F.col("cid").alias("other"), F.col("n").alias("m")), "other").groupBy("cid").agg(F.sum("m").alias("m"))
    classes = sizes.join(links, "cid", "left").join(group, "cid", "left").select("cid", F.coalesce("root", "cid").alias("root"), (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("n_links"))
    rows = members.join(classes, "cid")
    names = rows.groupBy("root").agg(F.min("item_key").alias("group_key"))
    return rows.join(names, "root").select("item_kind", "item_key", "group_key", "n_links")
