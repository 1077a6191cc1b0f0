"""Best representative of each duplicate group.

Method: token-level consensus.  The values of a group are aligned
progressively, weighted tokens vote per column, and the existing value closest
to the consensus survives.  ``consensus`` weighs values as given.  ``elect``
does it field by field with weights from declared ranks (trust, recency,
completeness), and names the row that the surviving value comes from.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.runtime import Scratch

#: Words that stand for a missing value, compared trimmed and in lower case.
PLACEHOLDERS = ("", "-", "n/a", "null", "unknown", "无", "未知", "待补充")
#: Origins from most to least trusted; anything else, null included, comes last.
ORIGINS = ("curated", "rule", "llm", "inferred")


def is_placeholder(text: Column) -> Column:
    """Null, blank (U+3000 included) or a word that stands for a missing value."""
    bare = F.lower(F.regexp_replace(text, r"(?U)^[\s　]+|[\s　]+$", ""))
    return F.coalesce(bare.isin(*PLACEHOLDERS), F.lit(True))


def trust_rank(origin: Column) -> Column:
    rank = F.lit(len(ORIGINS))
    for i, name in reversed(list(enumerate(ORIGINS))):
        rank = F.when(origin == name, i).otherwise(rank)
    return rank


def recency_rank(at: Column) -> Column:
    """Smaller is later; null is oldest of all."""
    return F.coalesce(-F.unix_micros(at.cast("timestamp")), F.lit(2**63 - 1))


def known_sources(sources: Column) -> Column:
    """Number of distinct (chunk_id, source_file, page) with a chunk_id; null counts as none."""
    keyed = F.filter(sources, lambda s: s["chunk_id"].isNotNull())
    bare = F.transform(keyed, lambda s: F.struct(s["chunk_id"], s["source_file"], s["page"]))
    return F.coalesce(F.size(F.array_distinct(bare)), F.lit(0))


def source_list(sources: Column) -> Column:
    """The distinct sources with a chunk_id as one value, a token each."""
    keyed = F.filter(sources, lambda s: s["chunk_id"].isNotNull())
    each = F.transform(keyed, lambda s: F.to_json(F.struct(s["chunk_id"], s["source_file"], s["page"])))
    return F.concat(F.array_join(F.array_sort(F.array_distinct(each)), MEMBER_END), F.lit(MEMBER_END))


# ---------------------------------------------------------------- consensus

TOKEN = re.compile(r"[0-9]+|[A-Za-z_]+|\s+|.", re.DOTALL)
#: Ends each member of a value that is a list; the members are its tokens.
MEMBER_END = "\x1f"


def tokens_of(value: str) -> list[str]:
    return value.split(MEMBER_END)[:-1] if MEMBER_END in value else TOKEN.findall(value)


def align(left: list[dict[str, float]], right: list[dict[str, float]], left_total: float, right_total: float) -> list[dict[str, float]]:
    """Merges two column profiles by global alignment; a text is a profile of one token a column.

    A column maps tokens to the weight that voted for them; '' is the gap.
    A match scores the chance that both columns name one token, a gap costs a half.
    """
    # Equal one-token columns at either end are part of a best alignment: only what lies between is searched.
    same = lambda a, b: len(a) == 1 and len(b) == 1 and "" not in a and a.keys() == b.keys()
    head, least = 0, min(len(left), len(right))
    while head < least and same(left[head], right[head]):
        head += 1
    tail = 0
    while tail < least - head and same(left[-1 - tail], right[-1 - tail]):
        tail += 1
    if head or tail:
        both = lambda xs, ys: [{t: w + y[t] for t, w in x.items()} for x, y in zip(xs, ys)]
        inner = align(left[head : len(left) - tail], right[head : len(right) - tail], left_total, right_total)
        return both(left[:head], right[:head]) + inner + both(left[len(left) - tail :], right[len(right) - tail :])
    n, m, gap = len(left), len(right), -0.5
    shares = [[(t, w / right_total / left_total) for t, w in c.items() if t] for c in right]

    def match(column: dict[str, float], share: list[tuple[str, float]]) -> float:
        if len(share) <= len(column):
            return 2 * sum([column.get(t, 0.0) * s for t, s in share]) - 0.6
        known = dict(share)
        return 2 * sum([w * known.get(t, 0.0) for t, w in column.items()]) - 0.6

    score = [[0.0] * (m + 1) for _ in range(n + 1)]
    pair = [[0.0] * m for _ in range(n)]
    for i in range(1, n + 1):
        score[i][0] = i * gap
    for j in range(1, m + 1):
        score[0][j] = j * gap
    for i in range(1, n + 1):
        column, row, above, pairs = left[i - 1], score[i], score[i - 1], pair[i - 1]
        for j in range(1, m + 1):
            share = shares[j - 1]
            pairs[j - 1] = p = 2 * column.get(share[0][0], 0.0) * share[0][1] - 0.6 if len(share) == 1 else match(column, share)
            row[j] = max(above[j - 1] + p, above[j] + gap, row[j - 1] + gap)
    out: list[dict[str, float]] = []
    i, j = n, m
    while i or j:
        if i and j and abs(score[i][j] - (score[i - 1][j - 1] + pair[i - 1][j - 1])) < 1e-9:
            column = dict(left[i - 1])
            for t, w in right[j - 1].items():
                column[t] = column.get(t, 0.0) + w
            i, j = i - 1, j - 1
        elif i and abs(score[i][j] - (score[i - 1][j] + gap)) < 1e-9:
            column = dict(left[i - 1])
            column[""] = column.get("", 0.0) + right_total
            i -= 1
        else:
            column = dict(right[j - 1])
            column[""] = column.get("", 0.0) + left_total
            j -= 1
        out.append(column)
    out.reverse()
    return out


def edit_distance(a: list[str], b: list[str]) -> int:
    head, least = 0, min(len(a), len(b))
    while head < least and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < least - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def merged_profile(parts: list[tuple[list[dict[str, float]], float]]) -> tuple[list[dict[str, float]], float]:
    """One profile and its weight from (profile, weight) pairs, aligned one after the other."""
    profile, total = parts[0]
    for other, weight in parts[1:]:
        profile = align(profile, other, total, weight)
        total += weight
    return profile, total


def value_profile(values: list[tuple[str, float]]) -> tuple[list[dict[str, float]], float]:
    """The profile of ``values`` (text, weight), heaviest first, and its weight."""
    ordered = sorted(values, key=lambda v: (-v[1], v[0]))
    return merged_profile([([{t: w} for t in tokens_of(v)], w) for v, w in ordered])


def voted_tokens(profile: list[dict[str, float]]) -> list[str]:
    voted = [min(c.items(), key=lambda kv: (-kv[1], kv[0]))[0] for c in profile]
    return [t for t in voted if t]


def consensus_value(values: list[tuple[str, float]]) -> str:
    """The value of ``values`` (text, weight) whose tokens lie closest to the weighted consensus."""
    voted = voted_tokens(value_profile(values)[0])
    return min(values, key=lambda v: (edit_distance(tokens_of(v[0]), voted), -v[1], v[0]))[0]


def settle(values: DataFrame, keys: list[str], weigh: Callable[[Column, Column, Column], Column], most_distinct: int, fan_in: int) -> DataFrame:
    """(keys, value, r): of each group the value that the consensus of its values chooses.

    ``values`` is (keys, value, r), each value of a group once; ``r`` orders
    them, smaller is better, and ``weigh(r, best r of the group, number of
    values)`` is a value's weight.  A group of more than ``most_distinct``
    values, and only such a group, is voted on in blocks of about that many:
    each block gives its full column profile, the profiles are merged
    ``fan_in`` at a time, and every value is then held against the consensus
    of them all.  No token and no value is dropped on the way; a task holds a
    block of values or the profiles it merges.
    """

    @F.pandas_udf("string")
    def vote(texts: pd.Series, weights: pd.Series) -> pd.Series:
        return pd.Series([consensus_value(list(zip(map(str, t), map(float, w)))) for t, w in zip(texts, weights)], dtype=object)

    @F.pandas_udf("string")
    def block_profile(texts: pd.Series, weights: pd.Series) -> pd.Series:
        return pd.Series([json.dumps(value_profile(list(zip(map(str, t), map(float, w))))) for t, w in zip(texts, weights)], dtype=object)

    @F.pandas_udf("string")
    def join_profiles(parts: pd.Series) -> pd.Series:
        return pd.Series([json.dumps(merged_profile([json.loads(x) for x in p])) for p in parts], dtype=object)

    @F.pandas_udf("string")
    def wording(profiles: pd.Series) -> pd.Series:
        return profiles.map(lambda p: json.dumps(voted_tokens(json.loads(p)[0])))

    @F.pandas_udf("long")
    def distance(texts: pd.Series, voted: pd.Series) -> pd.Series:
        return pd.Series([edit_distance(tokens_of(t), json.loads(v)) for t, v in zip(texts, voted)], dtype="int64")

    sizes = values.groupBy(*keys).agg(F.count("*").alias("n"), F.min("r").alias("best"))
    over = sizes.where(F.col("n") > most_distinct).withColumn("blocks", F.ceil(F.col("n") / most_distinct))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    level = values.join(over, keys, "left") if largest > most_distinct else values.withColumn("blocks", F.lit(None).cast("bigint"))
    gathered = level.where("blocks IS NULL").groupBy(*keys).agg(F.collect_list(F.struct("value", "r")).alias("votes"))
    ballot = lambda best: F.transform("votes", lambda v: weigh(v["r"], best, F.size("votes")))
    chosen = F.when(F.size("votes") == 1, F.col("votes")[0]["value"]).otherwise(vote("votes.value", ballot(F.array_min("votes.r"))))
    elected = gathered.withColumn("survivor", chosen).select(*keys, F.filter("votes", lambda v: v["value"] == F.col("survivor"))[0].alias("e")).select(*keys, "e.value", "e.r")
    if largest <= most_distinct:
        return elected
    blocked = level.where("blocks IS NOT NULL").select(*keys, "value", "r", weigh(F.col("r"), F.col("best"), F.col("n")).alias("w"), F.pmod(F.xxhash64("value"), F.col("blocks")).alias("block"))
    profiles = blocked.groupBy(*keys, "block").agg(F.collect_list("value").alias("texts"), F.collect_list("w").alias("ws")).select(*keys, "block", block_profile("texts", "ws").alias("profile"))
    most = -(-largest // most_distinct)
    while most > 1:
        merged = profiles.groupBy(*keys, F.floor(F.col("block") / fan_in).alias("block")).agg(F.sort_array(F.collect_list(F.struct("block", "profile"))).alias("parts"))
        profiles = merged.select(*keys, "block", join_profiles("parts.profile").alias("profile"))
        most = -(-most // fan_in)
    # One copy of the consensus for each block, so that a hot group's values stay spread over the tasks.
    voted = profiles.select(*keys, wording("profile").alias("voted")).join(over.select(*keys, "blocks"), keys).select(*keys, "voted", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"))
    near = blocked.join(voted, [*keys, "block"]).select(*keys, "value", "r", "w", distance("value", "voted").alias("d"))
    large = near.groupBy(*keys).agg(F.min_by(F.struct("value", "r"), F.struct("d", -F.col("w"), "value")).alias("e")).select(*keys, "e.value", "e.r")
    return elected.unionByName(large)


def consensus(df: DataFrame, group_key: Column, value: Column, weight: Column, most_distinct: int = 64, fan_in: int = 8) -> DataFrame:
    """(grp_key, n_rows, n_values, survivor): the value closest to each group's token consensus.

    Placeholders and nulls don't vote; a group without any other value gives no
    row.  Equal values are summed before anything is gathered, so a group
    costs its distinct values, not its rows; ``settle`` says how larger ones
    are voted on.  Weights outside (0, 1] count 0.05.
    """
    votes = df.select(group_key.alias("grp_key"), value.alias("value"), weight.cast("double").alias("w"))
    votes = votes.where(~is_placeholder(F.col("value")) & F.col("grp_key").isNotNull())
    safe = F.when(F.col("w").isNull() | F.isnan("w") | (F.col("w") <= 0) | (F.col("w") > 1), F.lit(0.05)).otherwise(F.col("w"))
    values = Scratch(df.sparkSession, "consensus").write(votes.groupBy("grp_key", "value").agg(F.sum(safe).alias("r"), F.count("*").alias("n")), "values")
    sizes = values.groupBy("grp_key").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_values"))
    survivors = settle(values.select("grp_key", "value", "r"), ["grp_key"], lambda r, best, n: r, most_distinct, fan_in)
    return survivors.join(sizes, "grp_key").select("grp_key", "n_rows", "n_values", F.col("value").alias("survivor"))


@dataclass(frozen=True)
class FieldRule:
    """A field, its value as text, which rows may give it, and what makes one of them better (less is better)."""

    field: str
    value: Column
    qualifies: Column
    ranks: tuple[Column, ...] = ()


def dominant(rank: Column, best: Column, n: Column) -> Column:
    """The weight of ranked voters: the best one outweighs all others together, who share half of its weight."""
    return F.when(rank == best, F.lit(1.0)).otherwise(F.lit(0.5) / n)


def elect(df: DataFrame, group_key: Column, row_id: str, updated_at: str, rules: list[FieldRule], most_distinct: int = 64, fan_in: int = 8) -> DataFrame:
    """(grp_key, field_name, row_id): whose value of each field survives, for groups of two rows or more.

    The distinct values of a field vote token by token as in ``consensus``.  A
    value's rank is that of its best row: the rule's ranks, then the latest
    ``updated_at`` (null oldest), then the smallest row id.  Ranks decide one
    after the other, so weights are ``dominant``: no number of worse rows
    outvotes a better one, and where two values differ the better one's tokens
    win the column.  The row named is the best one with the surviving value.

    Equal values are one voter and are merged map-side first, so a hot group
    costs its distinct values.  Rows repeated in full count once; a field no
    row qualifies for gives no row; groups with a null key give none.
    """
    rid = F.col(row_id).cast("bigint")
    longest = max(len(r.ranks) for r in rules)
    filled = lambda r: (*(x.cast("bigint") for x in r.ranks), *[F.lit(0).cast("bigint")] * (longest - len(r.ranks)))
    rank = lambda r: F.struct(*(x.alias(f"rank{i}") for i, x in enumerate(filled(r))), recency_rank(F.col(updated_at)).alias("age"), rid.alias("row_id"))
    fields = [F.struct(F.lit(r.field).alias("field_name"), F.when(r.qualifies, r.value).alias("value"), F.when(r.qualifies, rank(r)).alias("r")) for r in rules]
    rows = df.select(group_key.alias("grp_key"), rid.alias("rid"), F.array(*fields).alias("fields")).where("grp_key IS NOT NULL")
    scratch = Scratch(df.sparkSession, "elect")
    several = rows.groupBy("grp_key").agg(F.min("rid").alias("low"), F.max("rid").alias("high")).where("low < high").select("grp_key")
    each = rows.select("grp_key", F.inline("fields")).where("r IS NOT NULL")
    values = each.groupBy("grp_key", "field_name", "value").agg(F.min("r").alias("r")).join(several, "grp_key", "left_semi")
    values = scratch.write(values, "values")
    return settle(values, ["grp_key", "field_name"], dominant, most_distinct, fan_in).select("grp_key", "field_name", "r.row_id")
