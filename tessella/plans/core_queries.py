"""Queries of the core's own operators on the driver tables, with SQL oracles."""

from __future__ import annotations

from tessella.operators.hierarchy import descendants, hierarchy_table, resolve_hierarchy, resolve_roots
from tessella.runtime import table


def p2_found(spark, folder):
    """Nodes of the curriculum editions whose way up never ends, with their loop."""
    return resolve_roots(table(spark, folder, "curriculum_editions")).where("cycle_id IS NOT NULL").select("id", "cycle_id", "place")


def p2_hierarchy(spark, folder):
    """Every node with root, depth, path and the number of its descendants."""
    rows = hierarchy_table(resolve_hierarchy(table(spark, folder, "curriculum_editions"))).where("cycle_id IS NULL")
    return rows.selectExpr("id", "root", "cast(depth as bigint) AS depth", "array_join(path, '/') AS path", "n_descendants")


def p2_descendants(spark, folder):
    """Every node with each of its descendants and their distance."""
    return descendants(resolve_hierarchy(table(spark, folder, "curriculum_editions"))).selectExpr("id", "descendant", "cast(distance as bigint) AS distance")


_LINKS = r"""
newest AS (
  SELECT id, regexp_replace(parent_id, '^[\s\x{3000}]+|[\s\x{3000}]+$', '', 'g') AS p FROM (
    SELECT id, parent_id, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST, ingested_at DESC NULLS LAST, parent_id DESC NULLS LAST) AS k FROM curriculum_editions WHERE id IS NOT NULL) WHERE k = 1),
link AS (SELECT n.id, m.id AS p FROM newest n LEFT JOIN newest m ON n.p = m.id)"""


def _loops(steps: int = 14) -> str:
    """Pointer doubling: after 2^steps links only nodes above a loop still point somewhere."""
    parts = [f"WITH {_LINKS}", "j0 AS (SELECT id, p AS f, id AS m FROM link)"]
    for k in range(steps):
        parts.append(f"j{k + 1} AS MATERIALIZED (SELECT a.id, b.f, least(a.m, b.m) AS m FROM j{k} a LEFT JOIN j{k} b ON a.f = b.id)")
    return ",\n".join(parts) + f""",
ring AS (SELECT DISTINCT a.f AS id FROM j{steps} a WHERE a.f IS NOT NULL)
SELECT a.id, b.m AS cycle_id, CASE WHEN a.id IN (SELECT id FROM ring) THEN 'on' ELSE 'below' END AS place
FROM j{steps} a JOIN j{steps} b ON a.f = b.id WHERE a.f IS NOT NULL"""


_PATHS = f"""WITH RECURSIVE {_LINKS},
tree AS (
  SELECT id, id AS root, 0::BIGINT AS depth, [id] AS path FROM link WHERE p IS NULL
  UNION ALL
  SELECT l.id, t.root, t.depth + 1, list_append(t.path, l.id) FROM link l JOIN tree t ON l.p = t.id)"""

QUERIES = {"p2_found": p2_found, "p2_hierarchy": p2_hierarchy, "p2_descendants": p2_descendants}

SQL = {
    "p2_found": _loops(),
    "p2_hierarchy": _PATHS
    + """
SELECT t.id, t.root, t.depth, array_to_string(t.path, '/') AS path, coalesce(n.n, 0)::BIGINT AS n_descendants
FROM tree t LEFT JOIN (SELECT a AS id, count(*) AS n FROM (SELECT unnest(path[1:len(path) - 1]) AS a FROM tree) GROUP BY a) n ON n.id = t.id""",
    "p2_descendants": _PATHS
    + """
SELECT u.path[i] AS id, u.id AS descendant, (u.depth + 1 - i)::BIGINT AS distance
FROM tree u, unnest(range(1, u.depth + 1)) AS r(i)""",
}
