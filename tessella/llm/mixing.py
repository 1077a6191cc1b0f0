"""Mixing sources to target weights.

Method: balanced sampling by the cube method.  The total is the largest that
all targets allow under the repeat caps.  A source then needs each of its
documents an expected number of times: the whole part is taken outright, the
fraction is an inclusion probability.  The flight moves three probabilities at
a time along the null space of the balancing constraints, tokens and number of
documents, until one of them is 0 or 1.  Blocks of a source fly on their own
and leave two undecided documents each; these fly on together, level by level,
until a source has two left, which is the landing problem.

Every move keeps both totals of the source exactly, so the shares reached are
off by at most the landing's rounding of two documents a source.
"""

from __future__ import annotations

import random
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.bpe import DEFAULT_FOLDER, DEFAULT_NAME, encode_corpus
from tessella.runtime import Scratch

#: Documents that fly together in one task.
BLOCK = 20_000
TINY = 1e-9


def source_name(source: Column) -> Column:
    """One spelling for a source: lower case, without outer blanks, hyphens and blanks inside as underscores."""
    bare = F.regexp_replace(F.lower(source), r"(?U)^[\s　]+|[\s　]+$", "")
    return F.regexp_replace(bare, r"(?U)[\s\-]+", "_")


def fly(sizes: list[int], chances: list[float], rng: random.Random) -> list[float]:
    """The flight: chances moved to 0 or 1, all but two at most, with both totals kept."""
    out = list(chances)
    undecided: list[int] = []
    for k, p in enumerate(out):
        if not TINY < p < 1 - TINY:
            continue
        undecided.append(k)
        while len(undecided) == 3:
            i, j, l = undecided
            u = (float(sizes[l] - sizes[j]), float(sizes[i] - sizes[l]), float(sizes[j] - sizes[i]))
            if not any(u):
                u = (1.0, -1.0, 0.0)
            ups, downs = [], []
            for at, d in zip(undecided, u):
                if d > 0:
                    ups.append((1 - out[at]) / d)
                    downs.append(out[at] / d)
                elif d < 0:
                    ups.append(out[at] / -d)
                    downs.append((1 - out[at]) / -d)
            up, down = min(ups), min(downs)
            # The two ends of the line are taken so that the chances are kept in expectation.
            step = up if rng.random() * (up + down) < down else -down
            left = []
            for at, d in zip(undecided, u):
                p = out[at] + step * d
                p = 0.0 if p < TINY else 1.0 if p > 1 - TINY else p
                out[at] = p
                if 0.0 < p < 1.0:
                    left.append(at)
            if len(left) == 3:
                # Rounding kept all three inside: the nearest to an end is put there.
                at = min(left, key=lambda k: min(out[k], 1 - out[k]))
                out[at] = round(out[at])
                left.remove(at)
            undecided = left
    return out


def land(sizes: list[int], chances: list[float]) -> list[float]:
    """The landing: undecided chances rounded, then one swap that brings the tokens nearest to their due.

    The flight leaves the extremes of size undecided, so rounding alone may be
    off by the largest document; a taken and an untaken document change places
    where that makes up for it.  The number of documents stays as rounded.
    """
    open_ = [k for k, p in enumerate(chances) if 0.0 < p < 1.0]
    want = sum(chances[k] * sizes[k] for k in open_)
    best = min(range(1 << len(open_)), key=lambda m: (abs(sum(sizes[k] for b, k in enumerate(open_) if m >> b & 1) - want), m))
    out = list(chances)
    for b, k in enumerate(open_):
        out[k] = float(best >> b & 1)
    off = sum(out[k] * sizes[k] for k in open_) - want
    free = sorted((sizes[k], k) for k, p in enumerate(out) if p == 0.0)
    swap = (abs(off), -1, -1)
    for k in (k for k, p in enumerate(out) if p == 1.0):
        at = bisect_left(free, (sizes[k] - off, -1))
        for size, j in free[max(0, at - 1) : at + 1]:
            swap = min(swap, (abs(off + size - sizes[k]), k, j))
    if swap[1] >= 0:
        out[swap[1]], out[swap[2]] = 0.0, 1.0
    return out


def _level(rows: DataFrame, number: int, seed: int, last: bool) -> DataFrame:
    """One level of flights over (source, block); the last one also lands."""

    def run(batch: pa.Table) -> pa.Table:
        rows = sorted(zip(*(batch.column(c).to_pylist() for c in ("n_tokens", "doc_id", "chance"))))
        sizes, ids, chances = [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]
        source, block = batch.column("source")[0].as_py(), batch.column("block")[0].as_py()
        out = fly(sizes, chances, random.Random(f"{seed}/{number}/{source}/{block}"))
        if last:
            out = land(sizes, out)
        return pa.table({"source": pa.array([source] * len(ids), pa.string()), "doc_id": pa.array(ids, pa.int64()), "n_tokens": pa.array(sizes, pa.int32()), "chance": pa.array(out, pa.float64())})

    return rows.groupBy("source", "block").applyInArrow(run, "source string, doc_id bigint, n_tokens int, chance double")


def token_table(documents: DataFrame, scratch: Scratch, folder: str = DEFAULT_FOLDER, name: str = DEFAULT_NAME) -> DataFrame:
    """(doc_id, source, n_tokens) of every document once, sources spelled alike."""
    counts = encode_corpus(documents.select("doc_id", "text", "source"), "doc_id", "text", folder, name, count_only=True, keep=("source",))
    once = counts.where("doc_id IS NOT NULL").select("doc_id", source_name(F.col("source")).alias("source"), "n_tokens").groupBy("doc_id").agg(F.min("source").alias("source"), F.max("n_tokens").alias("n_tokens"))
    return scratch.write(once, "tokens")


def mixture(documents: DataFrame, targets: DataFrame, seed: int = 17, total: int | None = None, most_sources: int = 10_000, block: int = BLOCK, folder: str = DEFAULT_FOLDER, name: str = DEFAULT_NAME) -> tuple[DataFrame, DataFrame]:
    """The mixture (doc_id, source, n_tokens, repeats) and its report.

    The report has a row per source, listed or not: (source, target_share,
    max_repeats, n_documents, tokens, expected_repeats, mixed_tokens,
    reached_share).  Sources listed without documents reach nothing and their
    share is spread over the others in proportion; documents of sources not
    listed, without source or without tokens are not used.  ``total`` is the
    wanted number of tokens; the largest that the caps allow is the default
    and the limit.  The target list is collected, so its size is checked.  The
    draw depends on ``seed`` and the data only, not on the layout or on retries.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "mixture")
    wanted = targets.select(source_name(F.col("source")).alias("source"), F.col("target_share").cast("double").alias("share"), F.col("max_repeats").cast("int").alias("cap")).where("source IS NOT NULL").limit(most_sources + 1).collect()
    if len(wanted) > most_sources:
        raise ValueError(f"more than {most_sources} sources in the target list")
    share = {r.source: r.share for r in wanted if r.share and r.share > 0 and (r.cap or 0) > 0}
    cap = {r.source: r.cap for r in wanted}
    tokens = token_table(documents, scratch, folder, name)
    stock = {r.source: r for r in tokens.where(F.col("source").isin(sorted(share))).groupBy("source").agg(F.sum(F.col("n_tokens").cast("bigint")).alias("tokens"), F.count_if(F.col("n_tokens") > 0).alias("docs")).collect() if r.tokens}
    served = sum(share[s] for s in stock)
    most = min((cap[s] * r.tokens * served / share[s] for s, r in stock.items()), default=0.0)
    size = most if total is None else min(float(total), most)
    need = {s: size * share[s] / served / r.tokens for s, r in stock.items()}
    # A need that is whole but for rounding is whole.
    need = {s: float(round(v)) if abs(v - round(v)) < 1e-9 else v for s, v in need.items()}
    schema = "source string, expected_repeats double, blocks int"
    plan = spark.createDataFrame([(s, v, max(1, -(-stock[s].docs // block))) for s, v in sorted(need.items())], schema)
    usable = tokens.where("n_tokens > 0").join(F.broadcast(plan), "source")
    whole = F.floor("expected_repeats").cast("int")
    chance = F.col("expected_repeats") - F.floor("expected_repeats")
    start = usable.where(chance > 0).select("source", "doc_id", "n_tokens", chance.alias("chance"), F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int").alias("block"))
    blocks = max((-(-r.docs // block) for s, r in stock.items() if need[s] % 1), default=1)
    decided: list[DataFrame] = []
    level, number = start, 0
    while True:
        last = blocks <= 1
        flown = scratch.write(_level(level, number, seed, last), f"level{number}")
        decided.append(flown.where("chance = 1").select("doc_id", F.lit(1).alias("extra")))
        if last:
            break
        # Each block leaves two documents at most.
        blocks = -(-2 * blocks // block)
        level = flown.where("chance > 0 AND chance < 1").select("source", "doc_id", "n_tokens", "chance", F.pmod(F.xxhash64("doc_id", F.lit(number)), F.lit(blocks)).cast("int").alias("block"))
        number += 1
    extra = decided[0]
    for d in decided[1:]:
        extra = extra.unionByName(d)
    mixed = usable.join(extra, "doc_id", "left").select("doc_id", "source", "n_tokens", (whole + F.coalesce("extra", F.lit(0))).alias("repeats")).where("repeats > 0")
    return mixed, _report(tokens, mixed, targets, plan)


def _report(tokens: DataFrame, mixed: DataFrame, targets: DataFrame, plan: DataFrame) -> DataFrame:
    listed = targets.select(source_name(F.col("source")).alias("source"), "target_share", "max_repeats")
    held = tokens.groupBy("source").agg(F.count("*").alias("n_documents"), F.sum(F.col("n_tokens").cast("bigint")).alias("tokens"))
    taken = mixed.groupBy("source").agg(F.sum(F.col("n_tokens").cast("bigint") * F.col("repeats")).alias("mixed_tokens"))
    total = taken.agg(F.sum("mixed_tokens").alias("total"))
    rows = held.join(listed, "source", "full").join(plan.select("source", "expected_repeats"), "source", "left").join(taken, "source", "left").crossJoin(F.broadcast(total))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return rows.select("source", "target_share", "max_repeats", zero("n_documents").alias("n_documents"), zero("tokens").alias("tokens"), F.coalesce("expected_repeats", F.lit(0.0)).alias("expected_repeats"), zero("mixed_tokens").alias("mixed_tokens"), F.coalesce(F.col("mixed_tokens") / F.col("total"), F.lit(0.0)).alias("reached_share"))
