"""Entity resolution: normal names and types, merge links, components, merged nodes."""



import itertools
import math
import unicodedata
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from tessella.functions.coerce import fingerprint, safe_float, text
from tessella.operators.graph import graph_edges, graph_nodes, node_id, with_endpoints
from tessella.runtime import Scratch, is_empty
from tessella.vocabulary import NODE_TYPES, TYPE_ALIASES


@F.pandas_udf(StringType())
def compatibility_form(values: pd.Series) -> pd.Series:
    """NFKC; Spark has no built-in for it."""
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def normal_name(name: Column) -> Column:
    """One spelling: NFKC, single blanks, no blanks about hyphens, no outer marks."""
    value = text(compatibility_form(F.coalesce(name, F.lit(""))))
    value = F.regexp_replace(value, r"(?U)\s+", " ")
    value = F.regexp_replace(value, r"\s*-\s*", "-")
    return F.regexp_replace(value, r"^[ \t\r\n,，;；:：。.]+|[ \t\r\n,，;；:：。.]+$", "")


def normal_type(kind: Column) -> Column:
    """The type's name in the vocabulary where an alias says so, else as given; null becomes empty."""
    bare = text(kind)
    out = F.coalesce(*(F.when(F.lower(bare) == alias, F.lit(known)) for alias, known in TYPE_ALIASES.items()), bare)
    return F.when(bare.isin(*NODE_TYPES), bare).otherwise(out)


def prepared(entities: DataFrame, least: float = 0.55) -> DataFrame:
    """(raw_id, type, confidence, reason): entities with the reason that rejects them, null if none does."""
    once = entities.groupBy("raw_id").agg(F.min_by(F.struct("original_name", "original_type", "confidence"), F.struct("ingested_at", "original_name")).alias("e")).select("raw_id", "e.*")
    kind, sure = normal_type(F.col("original_type")), safe_float(F.col("confidence"), 0.0)
    reason = F.when(text(F.col("original_name")) == "", "name").when(~kind.isin(*NODE_TYPES), "type").when(sure < least, "confidence")
    return once.select("raw_id", kind.alias("type"), sure.alias("confidence"), reason.alias("reason"))


def name_links(entities: DataFrame) -> DataFrame:
    """(a, b): entities of one type whose names differ in marks only, tied to the least id as a star."""
    rows = entities.select("raw_id", "type", fingerprint(F.col("name")).alias("print")).where("print <> '' AND raw_id IS NOT NULL").distinct()
    heads = rows.groupBy("type", "print").agg(F.min("raw_id").alias("a"))
    return rows.join(heads, ["type", "print"]).where("raw_id <> a").select("a", F.col("raw_id").alias("b")).distinct()


def _known(entities: DataFrame) -> DataFrame:
    return entities.where("raw_id IS NOT NULL").select("raw_id").distinct()


def accepted_links(entities: DataFrame, matches: DataFrame) -> DataFrame:
    """(a, b): pairs of known records that a decision (verdict exactly ``same``) calls one entity."""
    known = _known(entities)
    same = matches.where("verdict = 'same' AND left_id <> right_id").select(F.least("left_id", "right_id").alias("a"), F.greatest("left_id", "right_id").alias("b")).distinct()
    return same.join(known.withColumnRenamed("raw_id", "a"), "a", "left_semi").join(known.withColumnRenamed("raw_id", "b"), "b", "left_semi").select("a", "b")


def equivalent_links(entities: DataFrame, nodes: DataFrame, edges: DataFrame, least: float = 0.9) -> DataFrame:
    """(a, b): the known records behind the two nodes of an ``equivalent_to`` edge, tied to the least one as a star.

    The edge's greatest sound confidence must reach ``least`` and its nodes be
    of one type; a node without a known record links nothing.
    """
    sure = graph_edges(edges).where((F.col("type") == "equivalent_to") & (F.col("confidence") >= least) & (F.col("source") != F.col("target")))
    pairs = with_endpoints(sure, graph_nodes(nodes)).where("source_type = target_type").select("source", "target")
    members = nodes.select(node_id(F.col("id")).alias("id"), F.explode("original_entity_ids").alias("raw_id")).join(_known(entities), "raw_id", "left_semi").distinct()
    ends = F.array(F.struct(F.lit(0).alias("side"), F.col("source").alias("id")), F.struct(F.lit(1).alias("side"), F.col("target").alias("id")))
    each = pairs.select("source", "target", F.inline(ends)).join(members, "id")
    heads = each.groupBy("source", "target").agg(F.min("raw_id").alias("a"), F.min("side").alias("low"), F.max("side").alias("high")).where("low < high")
    return each.join(heads, ["source", "target"]).where("raw_id <> a").select("a", F.col("raw_id").alias("b")).distinct()


def merge_links(entities: DataFrame, matches: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(a, b): all that says two records are one entity: names, sure equivalence, accepted pairs."""
    return name_links(entities).unionByName(equivalent_links(entities, nodes, edges)).unionByName(accepted_links(entities, matches)).distinct()


def union_groups(links: DataFrame) -> DataFrame:
    """(vertex, root): the least vertex each one is linked to, over any number of links.

    Every vertex takes the least label about it and then that label's own
    label, so distances halve each round; rounds are written and the lineage
    cut.  Aggregations and equi-joins only.
    """
    scratch = Scratch(links.sparkSession, "union")
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct()
    both = scratch.write(both, "links")
    labels = scratch.write(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("vertex"), F.least("a", "m").alias("root")), "labels0")
    turn = 0
    while True:
        around = both.join(labels, F.col("b") == F.col("vertex")).groupBy("a").agg(F.min("root").alias("m"))
        nearer = labels.join(around, labels.vertex == around.a, "left").select("vertex", F.least("root", F.coalesce("m", "root")).alias("root"), F.col("root").alias("old"))
        up = labels.select(F.col("vertex").alias("root"), F.col("root").alias("above"))
        jumped = nearer.join(up, "root", "left").select("vertex", F.least("root", F.coalesce("above", "root")).alias("root"), "old")
        turn += 1
        jumped = scratch.write(jumped, f"labels{turn}")
        scratch.drop(f"labels{turn - 1}")
        labels = jumped.select("vertex", "root")
        if is_empty(jumped.where("root <> old")):
            return labels


def merged_nodes(entities: DataFrame, groups: DataFrame) -> DataFrame:
    """(root, name, type, description, members, confidence): each group's best name, commonest type, longest description and greatest confidence.

    The best name is that of the surest member, then the shortest, then the
    least; ties of type and description fall to the least one.
    """
    sure = safe_float(F.col("confidence"), 0.0)
    once = entities.groupBy("raw_id").agg(F.min_by(F.struct("name", "type", "description", "confidence"), F.struct("ingested_at", "name")).alias("e")).select("raw_id", "e.*")
    rows = once.join(groups.select(F.col("vertex").alias("raw_id"), "root"), "raw_id", "left").select(F.coalesce("root", "raw_id").alias("root"), "name", "type", "description", sure.alias("confidence"))
    named = F.when(F.col("name").isNotNull(), F.struct(-F.col("confidence"), F.char_length("name"), F.col("name")))
    told = F.when(text(F.col("description")) != "", F.struct(-F.char_length("description"), F.col("description")))
    kinds = rows.groupBy("root", "type").agg(F.min(named).alias("named"), F.min(told).alias("told"), F.count("*").alias("n"), F.max("confidence").alias("confidence"))
    common = F.when(F.col("type").isNotNull(), F.struct(-F.col("n"), F.col("type")))
    merged = kinds.groupBy("root").agg(F.min("named").alias("named"), F.min(common).alias("common"), F.min("told").alias("told"), F.sum("n").alias("members"), F.max("confidence").alias("confidence"))
    return merged.select("root", "named.name", "common.type", "told.description", "members", "confidence")


def rooted(entities: DataFrame, groups: DataFrame) -> DataFrame:
    """The entities' rows with the root of their group, or their own id, as ``root``."""
    return entities.join(groups.select(F.col("vertex").alias("raw_id"), "root"), "raw_id", "left").withColumn("root", F.coalesce("root", "raw_id")).where("root IS NOT NULL")


def merged_aliases(entities: DataFrame, groups: DataFrame) -> DataFrame:
    """(root, alias): every name and original name in a group whose normal spelling isn't that of the merged node."""
    each = rooted(entities, groups).select("root", F.explode(F.array("original_name", "name")).alias("alias")).where("alias <> ''").distinct()
    shown = merged_nodes(entities, groups).select("root", "name")
    return each.join(shown, "root").where(~normal_name(F.col("alias")).eqNullSafe(normal_name(F.col("name")))).select("root", "alias")


#: Pairs of names of at most so many characters are found by what is left when characters are dropped, others by groups of letters.
WHOLE = 13


def _apart(a: int, b: int, least: float) -> int:
    """The most characters in no common block of two names of ``a`` and ``b`` characters at a ratio of ``least``; below ``|a - b|`` if they can't reach it."""
    most = math.floor((1 - least) * (a + b) + 1e-9)
    return most - (most - a - b) % 2


def _drops(least: float) -> list[tuple[bool, int, int, list[list[tuple[int, int]]]]]:
    """(longer, n, lengths, keeps): the pieces that names of ``n`` characters keep, as the longer or shorter ones of a pair of lengths."""
    out = []
    for low, high in itertools.combinations_with_replacement(range(1, WHOLE + 1), 2):
        both = (low + high - _apart(low, high, least)) // 2
        if 0 < both <= low and (low, both) != (high, high):
            for longer, n in ((False, low), (True, high)):
                gone = itertools.combinations(range(1, n + 1), n - both)
                out.append((longer, n, low * 100 + high, [[(x + 1, y - x - 1) for x, y in itertools.pairwise((0, *g, n + 1)) if y - x > 1] for g in gone]))
    return out


def _near_whole(names: DataFrame, least: float) -> DataFrame:
    """(type, left, right): pairs of names of at most ``WHOLE`` characters with enough characters in common, in order.

    Common blocks in order are one common subsequence, so both names come to
    the same string when the characters in no block are dropped.
    """
    plan = names.sparkSession.createDataFrame(_drops(least), "longer boolean, n int, lengths int, keeps array<array<struct<start:int,size:int>>>")
    rest = F.transform("keeps", lambda keep: F.array_join(F.transform(keep, lambda k: F.substring("name", k["start"], k["size"])), ""))
    keys = names.where(F.char_length("name") <= WHOLE).join(F.broadcast(plan), F.char_length("name") == F.col("n")).select("type", "name", "longer", "lengths", F.explode(F.array_distinct(rest)).alias("key"))
    low, high = keys.where("NOT longer").select("type", "lengths", "key", F.col("name").alias("low")), keys.where("longer").select("type", "lengths", "key", F.col("name").alias("high"))
    # Names of one length stand on both sides; one order of them is enough.
    met = low.hint("merge").join(high, ["type", "lengths", "key"]).where("low < high OR char_length(low) < char_length(high)")
    return met.select("type", F.least("low", "high").alias("left"), F.greatest("low", "high").alias("right"))


def _near_long(names: DataFrame, least: float) -> DataFrame:
    """(type, left, right): pairs with a name of more than ``WHOLE`` characters that share one of their rarest groups of letters.

    T letters in both names, u of them in no block: at most u + 1 blocks, each
    of which lacks ``size - 1`` groups, and u <= (1 - least) T.  So at least
    ``shared`` groups are common, and a pair meets in one of the others or the
    first of these, the groups taken from the rarest on.
    """
    fewest = (WHOLE + 1) * 2 / (2 - least)
    growth = {size: least / 2 - (size - 1) * (1 - least) for size in (1, 2, 3)}
    size = max(q for q in growth if q == 1 or fewest * growth[q] - (q - 1) >= 1)
    n = F.char_length("name")
    groups = F.transform(F.sequence(F.lit(1), n - size + 1), lambda i: F.substring("name", i, F.lit(size)))
    # A group counts once per occurrence: its second one is another token.
    marked = F.transform(groups, lambda x, i: F.concat(x, F.size(F.filter(F.slice(groups, F.lit(1), i + 1), lambda y: y == x)).cast("string")))
    able = names.where((n >= size) & (n * (2 - least) >= (WHOLE + 1) * least - 1e-9))
    tokens = able.select("type", "name", F.explode(marked).alias("token"))
    rarity = tokens.groupBy("type", "token").agg(F.count("*").alias("df"))
    order = Window.partitionBy("type", "name").orderBy("df", "token")
    ranked = tokens.hint("merge").join(rarity, ["type", "token"]).withColumn("place", F.row_number().over(order))
    shared = F.ceil(F.greatest(n * (2 / (2 - least)), F.lit(fewest)) * growth[size] - (size - 1) - 1e-9)
    prefix = ranked.where(F.col("place") <= n - size + 2 - shared).select("type", "name", "token")
    met = prefix.select("type", "token", F.col("name").alias("left")).hint("merge").join(prefix.select("type", "token", F.col("name").alias("right")), ["type", "token"]).where("left < right")
    a, b = F.char_length("left"), F.char_length("right")
    return met.where((F.greatest(a, b) > WHOLE) & (F.abs(a - b) <= (a + b) * (1 - least) + 1e-9)).select("type", "left", "right")


def _inside(names: DataFrame, shortest: int, size: int = 4) -> DataFrame:
    """(type, left, right): pairs of which one name, of more than ``shortest`` characters, stands in the other.

    A name can only stand in those that hold its rarest group of ``size``
    letters; one without such a group is looked up among all parts of its length.
    """
    n = F.char_length("name")

    def parts(length: int) -> Column:
        return F.when(n >= length, F.transform(F.sequence(F.lit(1), n - length + 1), lambda i: F.substring("name", i, F.lit(length)))).otherwise(F.array())

    held = names.select("type", "name", F.explode(F.array_distinct(parts(size))).alias("part"))
    rarity = held.groupBy("type", "part").agg(F.count("*").alias("df"))
    rarest = held.hint("merge").join(rarity, ["type", "part"]).groupBy("type", "name").agg(F.min(F.struct("df", "part")).alias("r")).select("type", F.col("name").alias("inner"), "r.part")
    met = rarest.where(F.char_length("inner") > shortest).hint("merge").join(held, ["type", "part"]).where((F.char_length("inner") < n) & F.contains("name", F.col("inner"))).select("type", "name", "inner")
    short = names.where((n > shortest) & (n < size)).select("type", F.col("name").alias("inner"))
    lengths = [r[0] for r in short.select(F.char_length("inner")).distinct().collect()]
    if lengths:
        all_parts = F.array_distinct(F.concat(*(parts(length) for length in lengths)))
        met = met.unionByName(names.select("type", "name", F.explode(all_parts).alias("inner")).where("name <> inner").hint("merge").join(short, ["type", "inner"]).select("type", "name", "inner"))
    return met.select("type", F.least("name", "inner").alias("left"), F.greatest("name", "inner").alias("right"))


def similar_candidates(names: DataFrame, least: float, shortest: int) -> DataFrame:
    """(type, left, right): the pairs of distinct (type, name) rows that ``similar_names`` compares in full."""
    return _near_whole(names, least).unionByName(_near_long(names, least)).unionByName(_inside(names, shortest)).distinct()


def _ratio(a: str, b: str) -> float:
    """The share of characters in common blocks, by longest blocks first."""
    # The one in the other is the longest block; from 200 characters on frequent ones start no block.
    if len(b) < 200 and (a in b or b in a):
        return 2.0 * min(len(a), len(b)) / (len(a) + len(b))
    return SequenceMatcher(None, a, b).ratio()


def _rated(batches: Iterator[pa.RecordBatch], least: float, shortest: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        ratio = [_ratio(a, b) for a, b in zip(left, right)]
        kept = [i for i, (a, b, x) in enumerate(zip(left, right, ratio)) if x >= least or min(len(a), len(b)) > shortest and (a in b or b in a)]
        at = pa.array(kept, pa.int64())
        yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in range(3)), pa.array([ratio[i] for i in kept], pa.float64())], names=["type", "left", "right", "ratio"])


def similar_names(entities: DataFrame, least: float = 0.88, shortest: int = 2) -> DataFrame:
    """(type, left, right, ratio): pairs of different fingerprints of a type that are nearly alike or one in the other.

    No name is held against all others: short names meet in what is left when
    characters are dropped, long ones in their rarest groups of letters, and
    containment in the rarest group of the name inside.  The distinct names
    are written once.
    """
    names = entities.select("type", fingerprint(F.col("name")).alias("name")).where("name <> '' AND type IS NOT NULL").distinct()
    names = Scratch(entities.sparkSession, "names").write(names, "names")
    rated = similar_candidates(names, least, shortest).mapInArrow(lambda it: _rated(it, least, shortest), "type string, left string, right string, ratio double")
    return rated.withColumn("ratio", F.round("ratio", 4))


#: Spellings of names, compared in lower case; each stands for one name.
NAME_ALIASES = {
    "oop": "面向对象编程",
    "面向对象": "面向对象编程",
    "面向对象程序设计": "面向对象编程",
    "programmingparadigm": "面向对象编程",
    "object-oriented programming": "面向对象编程",
    "class": "类",
    "object": "对象",
    "method": "方法",
    "field": "属性",
    "member variable": "属性",
    "constructor": "构造方法",
    "inheritance": "继承",
    "polymorphism": "多态",
    "encapsulation": "封装",
    "interface": "接口",
    "java": "Java",
    "java语言": "Java",
    "java language": "Java",
    "面向对象方法": "面向对象编程",
    "面向对象技术": "面向对象编程",
    "面向对象语言": "面向对象编程",
    "object oriented programming": "面向对象编程",
    "for 循环": "for循环",
    "for-loop": "for循环",
    "for loop": "for循环",
    "for语句": "for循环",
    "class关键字": "class",
    "extends关键字": "extends",
    "implements关键字": "implements",
    "interface关键字": "interface",
    "成员函数": "方法",
    "成员方法": "方法",
    "成员变量": "属性",
    "构造函数": "构造方法",
    "上塑造型": "向上转型",
}
#: Spellings of relations, compared as given and in lower case.
RELATION_ALIASES = {
    "属于": "part_of",
    "组成": "part_of",
    "包括": "part_of",
    "包含": "part_of",
    "是组成部分": "part_of",
    "partof": "part_of",
    "属于范式": "belongs_to_paradigm",
    "归属于范式": "belongs_to_paradigm",
    "前置知识": "prerequisite_of",
    "先修": "prerequisite_of",
    "需要先学习": "prerequisite_of",
    "prerequisite": "prerequisite_of",
    "实现于": "implemented_in",
    "由语言实现": "implemented_in",
    "语法是": "has_syntax",
    "具有语法": "has_syntax",
    "表达": "expresses_concept",
    "表达概念": "expresses_concept",
    "演示": "demonstrates",
    "示例说明": "demonstrates",
    "使用语法": "uses_syntax",
    "包含结构": "contains_structure",
    "考察": "assesses",
    "测试": "assesses",
    "需要能力": "requires_skill",
    "导致": "may_cause",
    "可能导致": "may_cause",
    "易混淆": "confused_with",
    "容易混淆": "confused_with",
    "等价": "equivalent_to",
    "同义": "equivalent_to",
    "不同于": "differs_from",
    "区别于": "differs_from",
    "继承": "inherits_from",
    "继承自": "inherits_from",
    "实现接口": "implements_interface",
}


def mapped_to(value: Column, table: dict[str, str]) -> Column:
    """What the table says of a value, else null; a literal map, so no join."""
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), value)


def canonical_name(name: Column, aliases: dict[str, str] = NAME_ALIASES) -> Column:
    """The name an entity goes by: normal spelling, ``Java`` joined to what follows, aliases, ``for循环`` without blank."""
    value = F.regexp_replace(normal_name(name), r"(?i)^java\s+", "Java")
    loop = F.regexp_replace(value, r"(?iU)\bfor\s+循环", "for循环")
    return F.coalesce(mapped_to(F.lower(value), aliases), loop)


def forced_type(name: Column, kind: Column, forced: dict[str, str], known=NODE_TYPES) -> Column:
    """The type that a name forces, else the vocabulary's one for the type as given."""
    return F.coalesce(mapped_to(canonical_name(name), forced), normal_type(kind)) if forced else normal_type(kind)


def canonical_relation(kind: Column, known, aliases: dict[str, str] = RELATION_ALIASES) -> Column:
    """The relation's name in the vocabulary: as given, by alias, or in lower case."""
    value = text(compatibility_form(F.coalesce(kind, F.lit(""))))
    low = F.lower(value)
    return F.when(value.isin(*known), value).otherwise(F.coalesce(mapped_to(value, aliases), F.when(low.isin(*known), low), mapped_to(low, aliases), low))


def entity_key(kind: Column, name: Column) -> Column:
    """What makes two entities one: type and fingerprint of the name."""
    return F.struct(kind.alias("type"), fingerprint(name).alias("print"))


def resolve_endpoints(relations: DataFrame, entities: DataFrame, sides: tuple[str, ...] = ("head", "tail")) -> DataFrame:
    """Relations with ``{side}_id``: the entity each end means, null if none.

    ``entities`` is (id, name, type, original_name, original_type, ord).  An end
    is looked up by its normal type and name, else as given; an entity answers
    to its normal and to its original names, of several the last by ``ord``.
    Two equi-joins a side.
    """
    spelled = F.array(F.struct(F.col("type").alias("t"), F.col("name").alias("n")), F.struct(F.col("original_type").alias("t"), F.col("original_name").alias("n")))
    keys = entities.select("id", "ord", F.inline(spelled)).select("id", "ord", entity_key(F.coalesce("t", F.lit("")), canonical_name(F.col("n"))).alias("key"))
    known = keys.where("key.print <> ''").groupBy("key").agg(F.max_by("id", F.struct("ord", "id")).alias("id"))
    out = relations
    for side in sides:
        normal = entity_key(normal_type(F.col(f"{side}_type")), canonical_name(F.col(side)))
        raw = entity_key(F.coalesce(F.col(f"{side}_type"), F.lit("")), F.coalesce(F.col(side), F.lit("")))
        first, second = known.select(F.col("key").alias("_k"), F.col("id").alias("_first")), known.select(F.col("key").alias("_k"), F.col("id").alias("_second"))
        out = out.withColumn("_n", normal).withColumn("_r", raw).join(first, F.col("_n") == F.col("_k"), "left").drop("_k").join(second, F.col("_r") == F.col("_k"), "left")
        out = out.withColumn(f"{side}_id", F.coalesce("_first", "_second")).drop("_k", "_n", "_r", "_first", "_second")
    return out


def inferred_entities(relations: DataFrame, entities: DataFrame, least: float = 0.55) -> DataFrame:
    """(name, type, confidence, relations): ends of relations that no entity stands for.

    ``relations`` has head, head_type, tail, tail_type, confidence; the
    confidence is that of the surest relation less 0.05, ``least`` at least.
    """
    ends = F.array(*(F.struct(F.col(s).alias("name"), F.col(f"{s}_type").alias("type")) for s in ("head", "tail")))
    each = relations.select(F.inline(ends), "confidence").select(canonical_name(F.col("name")).alias("name"), normal_type(F.col("type")).alias("type"), "confidence").where((F.col("name") != "") & F.col("type").isin(*NODE_TYPES))
    own = entities.select(entity_key(normal_type(F.col("type")), canonical_name(F.col("name"))).alias("key")).distinct()
    new = each.withColumn("key", entity_key(F.col("type"), F.col("name"))).join(own, "key", "left_anti")
    sure = F.greatest(F.lit(least), F.max(safe_float(F.col("confidence"), 0.0)) - 0.05)
    return new.groupBy("key").agg(F.min("name").alias("name"), sure.alias("confidence"), F.count("*").alias("relations")).select("name", "key.type", "confidence", "relations")
