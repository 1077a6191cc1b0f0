"""What a server or a command line calls: named routes to DataFrames, errors with a status, stages as commands.

No sockets here: a route takes a session, a folder of tables and parameters.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella import sinks
from tessella.operators import cleaning, graph, programming, questions, reports
from tessella.operators.hierarchy import resolve_hierarchy
from tessella.runtime import table


class ServiceError(Exception):
    """An error with the status it is answered with: 404 unknown, 400 bad parameter, 500 anything else."""

    def __init__(self, status: int, message: str):
        super().__init__(message)
        self.status = status


def _graph(spark, folder):
    return graph.graph_nodes(table(spark, folder, "standard_nodes")), graph.graph_edges(table(spark, folder, "standard_edges"))


def _known(nodes: DataFrame, id: str) -> str:
    key = id.strip().lower()
    if not nodes.where(F.col("id") == key).take(1):
        raise ServiceError(404, f"no node {id}")
    return key


def node_detail(spark, folder, id: str) -> dict[str, DataFrame]:
    """A node, its neighbours with their own degree, its relations and its questions."""
    nodes, edges = _graph(spark, folder)
    key = _known(nodes, id)
    around = graph.adjacency(edges).where(F.col("id") == key).select(F.col("neighbour").alias("id"))
    beside = graph.degrees(edges).join(around, "id", "left_semi")
    aliases = graph.node_aliases(table(spark, folder, "standard_nodes"))
    asked = questions.normalized(table(spark, folder, "questions"))
    own = nodes.where(F.col("id") == key)
    none = asked.limit(0).select("question_id", F.lit("").alias("id"), F.lit("").alias("name"))
    return {
        "node": own,
        "neighbours": around.join(nodes.select("id", "name", "type"), "id").join(beside, "id", "left").orderBy("name", "id"),
        "relations": edges.where((F.col("source") == key) | (F.col("target") == key)),
        "questions": questions.questions_of(own.select("id"), nodes, aliases, asked, none),
    }


def graph_view(spark, folder, id: str, depth: str = "1", most: int = 36) -> dict[str, DataFrame]:
    """The view of a node: its edges by the node's type, the nodes kept and the edges between them."""
    nodes, edges = _graph(spark, folder)
    key = _known(nodes, id)
    picked = graph.focus_edges(edges, nodes, key, _number(depth, 1))
    ids = picked.select(F.explode(F.array("source", "target")).alias("id")).unionByName(nodes.where(F.col("id") == key).select("id")).distinct()
    kept = graph.visible_nodes(ids, picked, key, most)
    return {"nodes": kept.join(nodes.select("id", "name", "type"), "id"), "edges": graph.induced(picked, kept)}


def _number(value: str, default: int) -> int:
    try:
        return int(value) if str(value).strip() else default
    except ValueError:
        raise ServiceError(400, f"no whole number: {value}") from None


def _search(spark, folder, q: str = "", limit: str = "12"):
    return reports.search(_graph(spark, folder)[0], questions.normalized(table(spark, folder, "questions")), q, _number(limit, 12))


def _questions(spark, folder, q: str = "", limit: str = "50"):
    return questions.listed(questions.normalized(table(spark, folder, "questions")), q, _number(limit, 50))


def _question(spark, folder, id: str):
    rows = questions.normalized(table(spark, folder, "questions")).where(F.col("question_id") == id.strip())
    if not rows.take(1):
        raise ServiceError(404, f"no question {id}")
    return rows


def _schema(spark, folder):
    nodes, edges = _graph(spark, folder)
    kinds = nodes.select(F.lit("node").alias("kind"), "type").unionByName(edges.select(F.lit("edge").alias("kind"), "type"))
    return kinds.distinct().orderBy("kind", "type")


def _health(spark, folder):
    nodes, edges = _graph(spark, folder)
    return graph.integrity(nodes, edges)


ROUTES: dict[str, Callable] = {
    "health": _health,
    "schema": _schema,
    "graph": lambda spark, folder: dict(zip(("nodes", "edges"), _graph(spark, folder))),
    "graphs": graph_view,
    "nodes": node_detail,
    "search": _search,
    "questions": _questions,
    "question": _question,
}


def endpoints() -> list[str]:
    return sorted(ROUTES)


def call(spark: SparkSession, folder: str, route: str, **parameters: str):
    """The answer of a route; every failure is a ``ServiceError`` with its status."""
    if route not in ROUTES:
        raise ServiceError(404, f"no route {route}; there are {', '.join(endpoints())}")
    try:
        return ROUTES[route](spark, folder, **parameters)
    except ServiceError:
        raise
    except (TypeError, ValueError) as error:
        raise ServiceError(400, str(error)) from error
    except Exception as error:
        raise ServiceError(500, str(error)) from error


def _preprocess(spark, folder, mode: str) -> DataFrame:
    raw = table(spark, folder, "raw_documents")
    if mode == "oop":
        return cleaning.preprocess(raw)
    catalog = table(spark, folder, "curriculum_catalog")
    time = F.lit(None).cast("timestamp")
    tree = resolve_hierarchy(catalog.select("id", "parent_id", time.alias("updated_at"), time.alias("ingested_at")))
    return programming.preprocess_programming(raw, catalog, tree)


def main(arguments: list[str]) -> int:
    """``preprocess`` or a route, its rows written as JSON lines; 0 if all went well, 1 with a message if not."""
    parser = argparse.ArgumentParser(prog="tessella")
    parser.add_argument("stage", choices=["preprocess", *endpoints()])
    parser.add_argument("--tables", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--mode", choices=["programming", "oop"], default="programming")
    parser.add_argument("--set", action="append", default=[], metavar="NAME=VALUE")
    chosen = parser.parse_args(arguments)
    spark = SparkSession.builder.getOrCreate()
    try:
        given = dict(s.split("=", 1) for s in chosen.set)
        found = _preprocess(spark, chosen.tables, chosen.mode) if chosen.stage == "preprocess" else call(spark, chosen.tables, chosen.stage, **given)
        for name, rows in found.items() if isinstance(found, dict) else [("", found)]:
            sinks.write_records(rows, f"{chosen.output}/{name}".rstrip("/"))
    except (ServiceError, ValueError) as error:
        print(error, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
