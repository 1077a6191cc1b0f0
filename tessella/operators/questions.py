"""Question operators: normalising, linking to knowledge nodes, evaluating links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessella.functions.coerce import distinct_texts, safe_int, text
from tessella.operators.graph import adjacency
from tessella.operators.matching import containing
from tessella.runtime import Scratch
from tessella.vocabulary import DIFFICULTIES, QUESTION_TYPES

#: Node types that questions are linked to.
LINKED_TYPES = ("KnowledgePoint", "KnowledgeUnit", "SyntaxRule", "ProgrammingLanguage")


def lookup(value: Column, table: dict) -> Column:
    out = F.lit(None).cast("string")
    for k, v in table.items():
        out = F.when(value == k, F.lit(v)).otherwise(out)
    return out


def gold_points(points: Column) -> Column:
    """Named points once per (name, role), stripped; a role other than primary is secondary."""
    clean = F.transform(points, lambda p: F.struct(text(p["name"]).alias("name"), F.when(text(p["role"]) == "primary", "primary").otherwise("secondary").alias("role")))
    kept = F.array_distinct(F.filter(clean, lambda p: p["name"] != ""))
    return F.coalesce(kept, F.array().cast("array<struct<name:string,role:string>>"))


def normalized(questions: DataFrame) -> DataFrame:
    """Typed questions with labels and the list of what is wrong with each; first row of an id only."""
    once = questions.groupBy("question_id").agg(F.min_by(F.struct("*"), F.struct("ingested_at", "stem")).alias("q")).select("q.*")
    kind = text(F.col("type"))
    level = safe_int(F.col("difficulty"), 2)
    gold = gold_points(F.col("gold_knowledge_points"))
    wrong = F.array_compact(
        F.array(
            F.when(~kind.isin(*QUESTION_TYPES), F.lit("type")),
            F.when(~level.between(1, 5), F.lit("difficulty")),
            F.when(text(F.col("stem")) == "", F.lit("stem")),
            F.when(F.size(gold) == 0, F.lit("gold")),
        )
    )
    bounded = F.greatest(F.lit(1), F.least(level, F.lit(5)))
    return once.select(
        text(F.col("question_id")).alias("question_id"),
        kind.alias("type"),
        F.coalesce(lookup(kind, QUESTION_TYPES), kind).alias("type_label"),
        F.when(text(F.col("language")) == "", "Java").otherwise(text(F.col("language"))).alias("language"),
        text(F.col("stem")).alias("stem"),
        F.coalesce("code", F.lit("")).alias("code"),
        distinct_texts(F.col("options")).alias("options"),
        text(F.col("answer")).alias("answer"),
        text(F.col("analysis")).alias("analysis"),
        bounded.alias("difficulty"),
        lookup(bounded, DIFFICULTIES).alias("difficulty_label"),
        distinct_texts(F.col("abilities")).alias("abilities"),
        gold.alias("gold"),
        wrong.alias("errors"),
    )


def search_text(q: DataFrame) -> Column:
    """Stem, code, answer, analysis and options in lines, without empty ones."""
    options = F.array_join("options", " ")
    return F.concat_ws("\n", *(F.when(c != "", c) for c in (F.col("stem"), F.col("code"), F.col("answer"), F.col("analysis"), options)))


def linkable(nodes: DataFrame) -> DataFrame:
    """(id, name, type): nodes that questions may link to; of one name the last in table order."""
    rows = nodes.where(F.col("type").isin(*LINKED_TYPES) & (text(F.col("name")) != ""))
    return rows.groupBy("name").agg(F.max_by(F.struct("id", "type"), "ord").alias("n")).select("n.id", "name", "n.type")


#: Words of a question and the knowledge they speak for.
KEYWORDS = {
    "class": ("类",),
    "类": ("类",),
    "object": ("对象",),
    "对象": ("对象",),
    "new ": ("对象",),
    "属性": ("属性",),
    "变量": ("属性",),
    "field": ("属性",),
    "方法": ("方法",),
    "method": ("方法",),
    "void ": ("方法",),
    "封装": ("封装", "信息隐藏"),
    "信息隐藏": ("信息隐藏", "封装"),
    "private": ("封装", "信息隐藏", "属性"),
    "public": ("封装", "方法"),
    "extends": ("继承", "父类"),
    "继承": ("继承",),
    "父类": ("父类", "继承"),
    "子类": ("继承", "父类"),
    "override": ("重写",),
    "@override": ("重写",),
    "重写": ("重写",),
    "覆盖": ("重写",),
    "多态": ("多态",),
    "父类引用": ("向上转型", "多态"),
    "父类 引用": ("向上转型", "多态"),
    "new dog": ("向上转型",),
    "new child": ("向上转型",),
    "向上转型": ("向上转型",),
    "动态绑定": ("动态绑定", "多态"),
    "运行期": ("动态绑定",),
    "运行时": ("动态绑定",),
    "实际对象类型": ("动态绑定", "向上转型", "类型"),
    "编译期类型": ("类型", "向上转型"),
    "类型": ("类型",),
    "interface": ("接口",),
    "implements": ("接口",),
    "接口": ("接口",),
    "多重继承": ("多重继承", "接口"),
    "abstract": ("abstract", "抽象类", "抽象"),
    "抽象类": ("抽象类", "abstract", "抽象"),
    "抽象": ("抽象",),
    "final": ("final",),
    "面向对象": ("面向对象编程",),
    "oop": ("面向对象编程",),
    "消息": ("消息传递",),
    "消息传递": ("消息传递",),
}


def scored(questions: DataFrame, nodes: DataFrame, aliases: DataFrame, edges: DataFrame, keywords: dict | None = None) -> DataFrame:
    """(question_id, name, id, score, evidence): what speaks for each node in each question.

    Three points for each name or alias in the text, two for each keyword rule
    that names the node, 0.8 for a neighbour of a node found so.  Evidence
    lists the five first reasons: names, then keywords, then the neighbour.
    """
    keywords = KEYWORDS if keywords is None else keywords
    scratch = Scratch(questions.sparkSession, "scored")
    known = scratch.write(linkable(nodes), "known")
    named = known.select("name", "id", F.col("name").alias("shown")).unionByName(known.join(aliases, "id").select("name", "id", F.col("alias").alias("shown")))
    phrases = named.select("name", "id", F.lower(text(F.col("shown"))).alias("phrase"), F.lit(3.0).alias("points"), F.concat(F.lit("名称："), "shown").alias("reason"), F.lit(0).alias("rank")).where("phrase <> ''")
    if keywords:
        rules = questions.sparkSession.createDataFrame([(n, k.lower(), f"特征：{k}") for k, ns in keywords.items() for n in ns], "name string, phrase string, reason string")
        rules = known.select("name", "id").join(F.broadcast(rules), "name").select("name", "id", "phrase", F.lit(2.0).alias("points"), "reason", F.lit(1).alias("rank"))
        phrases = phrases.unionByName(rules)
    phrases = scratch.write(phrases, "phrases")
    texts = questions.select("question_id", F.lower(search_text(questions)).alias("text"))
    hits = containing(texts, "question_id", "text", phrases, "phrase").join(phrases, "phrase")
    reasons = lambda: F.transform(F.slice(F.array_sort(F.collect_set(F.struct("rank", "reason"))), 1, 5), lambda r: r["reason"])
    direct = hits.groupBy("question_id", "name", "id").agg(F.sum("points").alias("score"), reasons().alias("evidence"))
    # What was found is read thrice below; the texts are searched once.
    direct = scratch.write(direct, "direct")
    near = direct.select("question_id", F.col("id").alias("from"), F.col("name").alias("via")).join(adjacency(edges).select(F.col("id").alias("from"), F.col("neighbour").alias("id")), "from").groupBy("question_id", "id").agg(F.min("via").alias("via"))
    beside = near.join(known.select("id", "name"), "id").join(direct.select("question_id", "name"), ["question_id", "name"], "left_anti").select("question_id", "name", "id", F.lit(0.8).alias("score"), F.array(F.concat(F.lit("邻居："), "via")).alias("evidence"))
    return direct.unionByName(beside)


def candidates(questions: DataFrame, nodes: DataFrame, aliases: DataFrame, edges: DataFrame, most: int = 12, keywords: dict | None = None) -> DataFrame:
    """(question_id, name, id, score, evidence, place): the ``most`` best nodes of each question by score and name."""
    order = Window.partitionBy("question_id").orderBy(F.desc("score"), "name")
    return scored(questions, nodes, aliases, edges, keywords).withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)


def rule_links(found: DataFrame, most: int = 5) -> DataFrame:
    """(question_id, name, id, role, confidence, evidence, place): candidates of three points or more, else the first."""
    strong = (F.col("score") >= 3) | (F.col("place") == 1)
    rows = found.where(strong & (F.col("place") <= most))
    role = F.when((F.col("place") <= 2) & (F.col("score") >= 3), "primary").otherwise("secondary")
    return rows.select("question_id", "name", "id", role.alias("role"), F.bround(F.least(F.lit(0.95), 0.45 + F.col("score") / 8), 3).alias("confidence"), F.array_join(F.slice("evidence", 1, 2), "；").alias("evidence"), "place")


def plain(name: Column) -> Column:
    return F.regexp_replace(F.lower(text(name)), " ", "")


def evaluation(questions: DataFrame, links: DataFrame) -> DataFrame:
    """Precision, recall, F1 and hits of each question; a question without links scores nothing."""
    gold = questions.select("question_id", F.array_distinct(F.filter(F.transform("gold", lambda p: plain(p["name"])), lambda n: n != "")).alias("gold"), F.array_distinct(F.filter(F.transform(F.filter("gold", lambda p: p["role"] == "primary"), lambda p: plain(p["name"])), lambda n: n != "")).alias("gold_primary"))
    listed = links.groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct("place", plain(F.col("name")).alias("name"), "role"))).alias("l"))
    names = F.transform("l", lambda x: x["name"])
    none = F.array().cast("array<string>")
    rows = gold.join(listed, "question_id", "left").select("question_id", "gold", "gold_primary", F.coalesce(F.array_distinct(names), none).alias("found"), F.coalesce(F.transform(F.filter("l", lambda x: x["role"] == "primary"), lambda x: x["name"]), none).alias("found_primary"), F.coalesce(F.slice(names, 1, 3), none).alias("top"))
    right = F.size(F.array_intersect("gold", "found"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    p, r = ratio(right, F.size("found")), ratio(right, F.size("gold"))
    return rows.select(
        "question_id",
        F.bround(p, 4).alias("precision"),
        F.bround(r, 4).alias("recall"),
        F.bround(ratio(2 * p * r, p + r), 4).alias("f1"),
        F.arrays_overlap("gold_primary", "found_primary").alias("primary_hit"),
        F.coalesce(F.array_contains("gold", F.get("top", F.lit(0))), F.lit(False)).alias("top_1_hit"),
        F.arrays_overlap("gold", "top").alias("top_3_hit"),
        (F.size("found") == 0).alias("unmapped"),
    )


def questions_of(ids: DataFrame, nodes: DataFrame, aliases: DataFrame, questions: DataFrame, links: DataFrame) -> DataFrame:
    """(question_id): questions linked to the nodes ``ids``: by link id, link name or gold name, against id, name and aliases in any case.

    The three ways are one union and one equi-join.
    """
    own = nodes.join(ids.select("id"), "id", "left_semi").select("id", "name")
    names = own.select(F.lower("id").alias("low")).unionByName(own.select(F.lower(text(F.col("name"))).alias("low"))).unionByName(aliases.join(ids.select("id"), "id", "left_semi").select(F.lower(text(F.col("alias"))).alias("low")))
    ways = links.select("question_id", F.explode(F.array(F.lower("id"), F.lower("name"))).alias("low")).unionByName(questions.select("question_id", F.explode(F.transform("gold", lambda p: F.lower(p["name"]))).alias("low")))
    return ways.join(names.where("low <> ''").distinct(), "low", "left_semi").select("question_id").distinct()


def listed(questions: DataFrame, word: str = "", limit: int = 50) -> DataFrame:
    """Questions that mention a word anywhere, by id, between 1 and 200 of them."""
    low = word.strip().lower()
    hay = F.lower(F.concat_ws(" ", "stem", "code", "answer", "analysis", F.array_join("abilities", " ")))
    rows = questions.where(F.contains(hay, F.lit(low))) if low else questions
    return rows.orderBy("question_id").limit(max(1, min(limit, 200)))
