"""Parent-child links to full hierarchies.

Method: every partition contracts its own parent chains to fragment exits (the
topmost ancestor it holds), the exits and the links between them form a much
smaller quotient forest, that forest is solved the same way, and its answers
are expanded back into the fragments.  Loops are found where they close: inside
a partition, or at whatever level their last link becomes local.

Rows are laid out by id range, because ids given together usually lie in one
tree.  Where that does not shrink the forest (links scattered at random) the
level contracts by coin toss instead: a node whose coin is tails hangs itself
on a parent whose coin is heads, which needs no locality and takes about a
quarter of the nodes away each time, whatever the shape of the trees.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import strip_blanks
from tessella.runtime import Scratch, is_empty

LEVEL = "id string, parent string, seg array<string>, loop string"
#: exit: topmost ancestor in the fragment; up: ids above the node up to the exit.
FRAGMENT = "id string, kind string, exit string, exit_parent string, exit_seg array<string>, up array<string>, cycle_id string, place string, also_on array<string>"


def current_links(df: DataFrame, id: str, parent: str, updated_at: str, tie: str) -> DataFrame:
    """(id, parent): of each id the latest row; parent null unless it is some node's id.

    Null ``updated_at`` is oldest; of rows equally late the one with the latest
    ``tie`` counts, then the one with the greatest parent.  Rows without an id
    are no nodes.
    """
    rows = df.select(F.col(id).cast("string").alias("id"), strip_blanks(F.col(parent).cast("string")).alias("parent"), F.struct(F.col(updated_at), F.col(tie), strip_blanks(F.col(parent).cast("string"))).alias("at")).where("id IS NOT NULL")
    newest = rows.groupBy("id").agg(F.max_by("parent", "at").alias("parent"))
    known = newest.select(F.col("id").alias("known"))
    return newest.join(known, F.col("parent") == F.col("known"), "left").select("id", F.col("known").alias("parent"))


def contract(rows: dict[str, tuple[str | None, list[str], str | None]]) -> Iterator[tuple]:
    """Fragment rows of one partition: id -> (parent, ids between, known loop above).

    The state of a node holds no path; its way up is walked when its row is
    given out, so memory is linear in the nodes however deep they lie.
    """
    state: dict[str, tuple] = {}
    for start in rows:
        chain, here, at = [], start, {}
        while here not in state and here in rows and here not in at:
            at[here] = len(chain)
            chain.append(here)
            here = rows[here][0]
            if here is None:
                break
        if here is not None and here in at:
            # The chain closed on itself: everything from there on is the loop.
            ring = chain[at[here] :]
            least = min(m for n in ring for m in (n, *rows[n][1]))
            for n in ring:
                state[n] = ("cycle", None, None, None, least, "on", rows[n][1])
            chain = chain[: at[here]]
        for n in reversed(chain):
            parent, seg, loop = rows[n]
            if loop is not None:
                state[n] = ("cycle", None, None, None, loop, "below", ())
            elif parent is None:
                state[n] = ("root", n, None, (), None, None, ())
            elif parent not in rows:
                state[n] = ("open", n, parent, seg, None, None, ())
            elif state[parent][0] == "cycle":
                state[n] = ("cycle", None, None, None, state[parent][4], "below", ())
            else:
                state[n] = state[parent]
    for n in rows:
        kind, exit, exit_parent, exit_seg, *rest = state[n]
        up, here = [], n
        while exit is not None and here != exit:
            parent, seg, _ = rows[here]
            up += seg
            up.append(parent)
            here = parent
        yield (n, kind, exit, exit_parent, exit_seg, up, *rest)


def contract_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: dict[str, tuple] = {}
    for batch in batches:
        for i, p, s, l in zip(*(c.to_pylist() for c in batch.columns)):
            rows[i] = (p, s or [], l)
    names = ["id", "kind", "exit", "exit_parent", "exit_seg", "up", "cycle_id", "place", "also_on"]
    lists = {"exit_seg", "up", "also_on"}
    buffer: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*buffer))
        arrays = [pa.array([list(x) if x is not None else None for x in c] if n in lists else c, pa.list_(pa.string()) if n in lists else pa.string()) for n, c in zip(names, columns)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    held = 0
    for row in contract(rows):
        buffer.append(row)
        held += 1 + len(row[5])
        if held > 50_000:
            yield flush()
            buffer, held = [], 0
    if buffer:
        yield flush()


def toss(level: DataFrame, salt: int) -> DataFrame:
    """The coin-toss contraction of a level, in the form of fragments."""
    heads = lambda c: F.pmod(F.xxhash64(c, F.lit(salt)), F.lit(2)) == 0
    none = F.array().cast("array<string>")
    hangs = F.col("parent").isNotNull() & F.col("loop").isNull() & ~heads(F.col("id")) & heads(F.col("parent")) & (F.col("id") != F.col("parent"))
    alone = F.when(F.col("loop").isNotNull() | (F.col("id") == F.col("parent")), "cycle").when(F.col("parent").isNull(), "root").otherwise("open")
    own_loop = F.col("id") == F.col("parent")
    # A node that hangs on a parent is a fragment of that parent; whether the parent's chain goes on is the parent's row to say.
    return level.select(
        "id",
        F.when(hangs, "hung").otherwise(alone).alias("kind"),
        F.when(hangs, F.col("parent")).when(alone != "cycle", F.col("id")).alias("exit"),
        F.when(~hangs & (alone == "open"), F.col("parent")).alias("exit_parent"),
        F.when(~hangs & (alone == "open"), F.col("seg")).otherwise(none).alias("exit_seg"),
        F.when(hangs, F.concat("seg", F.array("parent"))).otherwise(none).alias("up"),
        F.when(own_loop & F.col("loop").isNull(), F.array_min(F.concat("seg", F.array("id")))).otherwise(F.col("loop")).alias("cycle_id"),
        F.when(own_loop & F.col("loop").isNull(), "on").when(F.col("loop").isNotNull(), "below").alias("place"),
        F.when(own_loop, F.col("seg")).otherwise(none).alias("also_on"),
    )


def solve(level: DataFrame, scratch: Scratch, rows_per_task: int, depth: int = 0, tossed: bool = False) -> DataFrame:
    """(id, root, up, cycle_id, place, also_on) of every row of a level."""
    spark = scratch.spark
    total = level.count()
    tasks = max(1, -(-total // rows_per_task))
    if tossed and tasks > 1:
        fragments = toss(level, depth)
    else:
        laid = level.coalesce(1) if tasks == 1 else level.repartitionByRange(tasks, "id")
        fragments = laid.mapInArrow(contract_partition, FRAGMENT)
    fragments = scratch.write(fragments, f"fragments{depth}")
    done = fragments.where("kind IN ('root', 'cycle')").select("id", F.when(F.col("kind") == "root", F.col("exit")).alias("root"), "up", "cycle_id", "place", "also_on")
    if tasks == 1:
        return done
    # A link between fragments: an open exit, its parent, and the fragment that holds the parent.
    exits = fragments.where("kind = 'open' AND id = exit").select("id", F.col("exit_parent").alias("p"), F.col("exit_seg").alias("s"))
    holds = fragments.select(F.col("id").alias("p"), F.col("kind").alias("k"), F.col("exit").alias("e"), F.col("up").alias("u"), F.col("cycle_id").alias("c"))
    steps = F.concat("s", F.when(F.col("e") == F.col("p"), F.array().cast("array<string>")).otherwise(F.concat(F.array("p"), F.slice("u", F.lit(1), F.greatest(F.size("u") - 1, F.lit(0))))))
    linked = exits.join(holds, "p").select("id", F.when(F.col("k") != "cycle", F.col("e")).alias("parent"), F.when(F.col("k") != "cycle", steps).otherwise(F.array().cast("array<string>")).alias("seg"), F.col("c").alias("loop"), "k", "e")
    linked = scratch.write(linked, f"links{depth}")
    tops = linked.where("k <> 'cycle'").select(F.col("e").alias("id")).distinct().join(exits.select("id"), "id", "left_anti")
    if tossed:
        # A toss leaves whole fragments open: their tops are roots or loops of this level and are answered as such.
        loops = fragments.where("kind = 'cycle'").select("id", F.col("cycle_id").alias("loop"))
        tops = tops.join(loops, "id", "left").select("id", F.lit(None).cast("string").alias("parent"), F.array().cast("array<string>").alias("seg"), "loop")
        hung = fragments.where("kind = 'hung'").select(F.col("exit").alias("id")).distinct()
        extra = hung.join(exits.select("id"), "id", "left_anti").join(tops.select("id"), "id", "left_anti").join(loops, "id", "left")
        tops = tops.unionByName(extra.select("id", F.lit(None).cast("string").alias("parent"), F.array().cast("array<string>").alias("seg"), "loop"))
    else:
        tops = tops.select("id", F.lit(None).cast("string").alias("parent"), F.array().cast("array<string>").alias("seg"), F.lit(None).cast("string").alias("loop"))
    quotient = scratch.write(linked.select("id", "parent", "seg", "loop").unionByName(tops), f"quotient{depth}")
    slow = spark.read.parquet(scratch.paths[f"quotient{depth}"]).count() > 0.7 * total
    solved = solve(quotient, scratch, rows_per_task, depth + 1, slow)
    solved = scratch.write(solved, f"solved{depth}")
    # Expand: a node takes its exit's answer, with its own way to the exit put before it.
    above = solved.select(F.col("id").alias("exit"), F.col("root").alias("r"), F.col("up").alias("a"), F.col("cycle_id").alias("c"), F.col("place").alias("pl"), F.col("also_on").alias("ao"))
    expanded = fragments.where("kind IN ('open', 'hung')").join(above, "exit").select("id", F.col("r").alias("root"), F.when(F.col("r").isNotNull(), F.concat("up", "a")).otherwise(F.array().cast("array<string>")).alias("up"), F.col("c").alias("cycle_id"), F.when(F.col("c").isNull(), F.lit(None)).when(F.col("id") == F.col("exit"), F.col("pl")).otherwise("below").alias("place"), F.when(F.col("id") == F.col("exit"), F.col("ao")).otherwise(F.array().cast("array<string>")).alias("also_on"))
    # Contracted links of a loop carry further members of it.
    on_loop = solved.where("place = 'on' AND size(also_on) > 0").select(F.explode("also_on").alias("id"), F.lit(True).alias("closes"))
    expanded = expanded.join(on_loop, "id", "left").withColumn("place", F.when(F.col("closes"), "on").otherwise(F.col("place"))).drop("closes")
    return done.unionByName(expanded) if not tossed else done.join(expanded.select("id"), "id", "left_anti").unionByName(expanded)


def resolve_hierarchy(df: DataFrame, id: str = "id", parent: str = "parent_id", updated_at: str = "updated_at", tie: str = "ingested_at", rows_per_task: int = 50_000) -> DataFrame:
    """Path, depth and root of every node, or the loop that keeps it from having them.

    Gives (id, root, depth, path, cycle_id, place).  ``path`` runs from the root
    to the node itself.  A node is a root if its parent is null, blank or no
    node's id.  Nodes from which going up never ends have null root, depth and
    path; ``cycle_id`` is the smallest id of the loop by code point and
    ``place`` is ``on`` for its members, ``below`` for nodes that run into it.
    An empty table gives an empty result; further columns are ignored.
    """
    scratch = Scratch(df.sparkSession, "hierarchy")
    links = current_links(df, id, parent, updated_at, tie)
    level = scratch.write(links.select("id", "parent", F.array().cast("array<string>").alias("seg"), F.lit(None).cast("string").alias("loop")), "links")
    solved = solve(level, scratch, rows_per_task)
    on_path = F.col("cycle_id").isNull()
    return solved.select(
        "id",
        F.when(on_path, F.col("root")).alias("root"),
        F.when(on_path, F.size("up")).alias("depth"),
        F.when(on_path, F.concat(F.reverse("up"), F.array("id"))).alias("path"),
        "cycle_id",
        "place",
    )


#: gap: links from id up to parent; low: smallest id from id (inclusive) to parent (exclusive).
LIGHT_LEVEL = "id string, parent string, gap bigint, low string, loop string"
#: hops: links from the node up to its exit; lowest: smallest id from the node to the exit, the exit not counted.
LIGHT_FRAGMENT = "id string, parent string, gap bigint, low string, kind string, exit string, hops bigint, lowest string, cycle_id string, place string"


def contract_light(rows: dict[str, tuple[str | None, int, str, str | None]]) -> Iterator[tuple]:
    """Fragment rows of one partition without paths: id -> (parent, gap, low, known loop above)."""
    state: dict[str, tuple] = {}
    for start in rows:
        chain, here, at = [], start, {}
        while here is not None and here not in state and here in rows and here not in at:
            at[here] = len(chain)
            chain.append(here)
            here = rows[here][0]
        if here is not None and here in at:
            ring = chain[at[here] :]
            least = min(rows[n][2] for n in ring)
            for n in ring:
                state[n] = ("cycle", None, 0, None, least, "on")
            chain = chain[: at[here]]
        for n in reversed(chain):
            parent, gap, low, loop = rows[n]
            if loop is not None:
                state[n] = ("cycle", None, 0, None, loop, "below")
            elif parent is None or parent not in rows:
                state[n] = ("root" if parent is None else "open", n, 0, None, None, None)
            else:
                kind, exit, hops, lowest, cycle, _ = state[parent]
                state[n] = ("cycle", None, 0, None, cycle, "below") if kind == "cycle" else (kind, exit, hops + gap, low if lowest is None else min(low, lowest), None, None)
    for n in rows:
        yield (n, *rows[n][:3], *state[n])


def _records(rows, schema: pa.Schema, most: int = 50_000) -> Iterator[pa.RecordBatch]:
    buffer: list[tuple] = []
    for row in rows:
        buffer.append(row)
        if len(buffer) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*buffer), schema.types)], schema=schema)
            buffer = []
    if buffer:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*buffer), schema.types)], schema=schema)


def _contract_light_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = {i: rest for b in batches for i, *rest in zip(*(c.to_pylist() for c in b.columns))}
    text, number = pa.string(), pa.int64()
    yield from _records(contract_light(rows), pa.schema(list(zip(["id", "parent", "gap", "low", "kind", "exit", "hops", "lowest", "cycle_id", "place"], [text, text, number, text, text, text, number, text, text, text]))))


def _mark_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (id, parent, entry) the ids on the way up from an entry."""
    parent, entries = {}, []
    for b in batches:
        for i, p, entry in zip(*(c.to_pylist() for c in b.columns)):
            parent[i] = p
            if entry:
                entries.append(i)
    marked = set()
    for here in entries:
        while here in parent and here not in marked:
            marked.add(here)
            here = parent[here]
    yield from _records(((i,) for i in marked), pa.schema([("id", pa.string())]))


def toss_light(level: DataFrame, salt: int) -> DataFrame:
    """The coin-toss contraction of a level without paths."""
    heads = lambda c: F.pmod(F.xxhash64(c, F.lit(salt)), F.lit(2)) == 0
    own_loop = F.col("id") == F.col("parent")
    cycle = F.col("loop").isNotNull() | F.coalesce(own_loop, F.lit(False))
    hangs = F.col("parent").isNotNull() & ~cycle & ~heads(F.col("id")) & heads(F.col("parent"))
    return level.select(
        "id",
        "parent",
        "gap",
        "low",
        F.when(cycle, "cycle").when(hangs, "hung").when(F.col("parent").isNull(), "root").otherwise("open").alias("kind"),
        F.when(hangs, F.col("parent")).otherwise(F.col("id")).alias("exit"),
        F.when(hangs, F.col("gap")).otherwise(F.lit(0).cast("bigint")).alias("hops"),
        F.when(hangs, F.col("low")).alias("lowest"),
        F.when(F.col("loop").isNotNull(), F.col("loop")).when(cycle, F.col("low")).alias("cycle_id"),
        F.when(F.col("loop").isNotNull(), "below").when(cycle, "on").alias("place"),
    )


def solve_light(level: DataFrame, scratch: Scratch, rows_per_task: int, depth: int = 0, tossed: bool = False) -> DataFrame:
    """(id, root, depth, cycle_id, place) of every row of a level."""
    total = level.count()
    tasks = max(1, -(-total // rows_per_task))
    tossed = tossed and tasks > 1
    if tossed:
        fragments = toss_light(level, depth)
    else:
        laid = level.coalesce(1) if tasks == 1 else level.repartitionByRange(tasks, "id")
        fragments = laid.mapInArrow(_contract_light_partition, LIGHT_FRAGMENT)
    answers = lambda df: df.select("id", F.when(F.col("kind") == "root", F.col("exit")).alias("root"), F.when(F.col("kind") == "root", F.col("hops")).alias("depth"), "cycle_id", "place")
    if tasks == 1:
        return answers(fragments)
    fragments = scratch.write(fragments, f"light{depth}")
    waiting = fragments.where("kind IN ('open', 'hung')")
    exits = waiting.where("id = exit").select("id", F.col("parent").alias("p"), "gap", "low")
    holds = fragments.select(F.col("id").alias("p"), F.col("kind").alias("k"), F.col("exit").alias("e"), F.col("hops").alias("h"), F.col("lowest").alias("l"), F.col("cycle_id").alias("c"))
    free = F.col("k") != "cycle"
    linked = exits.join(holds, "p").select("id", F.when(free, F.col("e")).alias("parent"), (F.col("gap") + F.col("h")).alias("gap"), F.least("low", "l").alias("low"), F.col("c").alias("loop"))
    linked = scratch.write(linked, f"lightlinks{depth}")
    # Exits that nothing links further up: roots, and in a toss single nodes on or below a loop.
    ends = linked.where("parent IS NOT NULL").select(F.col("parent").alias("id")).unionByName(waiting.select(F.col("exit").alias("id"))).distinct().join(exits.select("id"), "id", "left_anti")
    tops = ends.join(fragments.select("id", "cycle_id"), "id").select("id", F.lit(None).cast("string").alias("parent"), F.lit(0).cast("bigint").alias("gap"), F.col("id").alias("low"), F.col("cycle_id").alias("loop"))
    quotient = scratch.write(linked.unionByName(tops), f"lightquotient{depth}")
    slow = quotient.count() > 0.7 * total
    solved = scratch.write(solve_light(quotient, scratch, rows_per_task, depth + 1, slow), f"lightsolved{depth}")
    above = solved.select(F.col("id").alias("exit"), "root", F.col("depth").alias("d"), "cycle_id", "place")
    expanded = waiting.select("id", "exit", "hops").join(above, "exit").select("id", "root", (F.col("d") + F.col("hops")).alias("depth"), "cycle_id", F.when(F.col("id") == F.col("exit"), F.col("place")).when(F.col("cycle_id").isNotNull(), "below").alias("place"))
    ring = solved.where("place = 'on'").select("id")
    if not is_empty(ring):
        # The loop enters a fragment at the parents of the exits on it and leaves by the fragment's exit.
        entries = exits.join(ring, "id", "left_semi").select(F.col("p").alias("id"), F.lit(True).alias("entry")).distinct()
        if tossed:
            on = entries.select("id")
        else:
            touched = waiting.join(ring.withColumnRenamed("id", "exit"), "exit", "left_semi").join(entries, "id", "left")
            on = touched.repartition("exit").select("id", F.when(F.col("id") != F.col("exit"), F.col("parent")).alias("parent"), F.coalesce("entry", F.lit(False)).alias("entry")).mapInArrow(_mark_partition, "id string")
        expanded = expanded.join(on.withColumn("closes", F.lit(True)), "id", "left").withColumn("place", F.when(F.col("closes"), "on").otherwise(F.col("place"))).drop("closes")
    return answers(fragments.where("kind IN ('root', 'cycle')")).unionByName(expanded)


def resolve_roots(df: DataFrame, id: str = "id", parent: str = "parent_id", updated_at: str = "updated_at", tie: str = "ingested_at", rows_per_task: int = 200_000) -> DataFrame:
    """(id, root, depth, cycle_id, place): as ``resolve_hierarchy``, but without paths.

    Nothing here grows with the depth of a node: a link between fragments
    carries how many links it stands for and the smallest id on them, so a
    chain of any length costs its rows.
    """
    scratch = Scratch(df.sparkSession, "roots")
    links = current_links(df, id, parent, updated_at, tie)
    level = scratch.write(links.select("id", "parent", F.lit(1).cast("bigint").alias("gap"), F.col("id").alias("low"), F.lit(None).cast("string").alias("loop")), "links")
    return solve_light(level, scratch, rows_per_task)


def _sum_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of whole fragments (id, parent, weight) the sum of each node's subtree."""
    parent, total = {}, {}
    for b in batches:
        for i, p, w in zip(*(c.to_pylist() for c in b.columns)):
            parent[i], total[i] = p, w
    waiting = dict.fromkeys(parent, 0)
    for p in parent.values():
        if p in waiting:
            waiting[p] += 1
    ready = [i for i, n in waiting.items() if not n]
    while ready:
        i = ready.pop()
        p = parent[i]
        if p in total:
            total[p] += total[i]
            waiting[p] -= 1
            if not waiting[p]:
                ready.append(p)
    yield from _records(total.items(), pa.schema([("id", pa.string()), ("total", pa.int64())]))


def subtree_totals(level: DataFrame, scratch: Scratch, rows_per_task: int = 200_000, depth: int = 0, tossed: bool = False) -> DataFrame:
    """(id, total): the sum of ``weight`` over each node and all below it; ``level`` (id, parent, weight) is a forest.

    Fragments are summed, their sums go up the quotient forest, and what comes
    back from below is added where it enters a fragment: no row per ancestor.
    """
    level = scratch.write(level, f"weights{depth}")
    total = level.count()
    tasks = max(1, -(-total // rows_per_task))
    if tasks == 1:
        return level.coalesce(1).mapInArrow(_sum_partition, "id string, total bigint")
    shape = level.select("id", "parent", F.lit(1).cast("bigint").alias("gap"), F.col("id").alias("low"), F.lit(None).cast("string").alias("loop"))
    fragments = toss_light(shape, depth + 100) if tossed else shape.repartitionByRange(tasks, "id").mapInArrow(_contract_light_partition, LIGHT_FRAGMENT)
    fragments = scratch.write(fragments.select("id", "parent", "exit").join(level.select("id", "weight"), "id"), f"parts{depth}")
    exits = fragments.where("id = exit").select("id", F.col("parent").alias("p"))
    over = fragments.select(F.col("id").alias("p"), F.col("exit").alias("above"))
    sums = fragments.groupBy(F.col("exit").alias("id")).agg(F.sum("weight").alias("weight"))
    quotient = exits.join(over, "p", "left").join(sums, "id").select("id", F.col("above").alias("parent"), "weight")
    quotient = scratch.write(quotient, f"weightquotient{depth}")
    slow = quotient.count() > 0.7 * total
    below = subtree_totals(quotient, scratch, rows_per_task, depth + 1, slow)
    entering = exits.join(below, "id").where("p IS NOT NULL").groupBy(F.col("p").alias("id")).agg(F.sum("total").alias("more"))
    inner = fragments.join(entering, "id", "left").repartition("exit")
    return inner.select("id", F.when(F.col("id") != F.col("exit"), F.col("parent")).alias("parent"), (F.col("weight") + F.coalesce("more", F.lit(0))).alias("weight")).mapInArrow(_sum_partition, "id string, total bigint")


def descendants(resolved: DataFrame) -> DataFrame:
    """(id, descendant, distance): every node with each node below it, as rows.

    Rows rather than arrays, so that a root above a third of all nodes never
    becomes one value.
    """
    below = resolved.where("depth > 0").select(F.col("id").alias("descendant"), "depth", F.posexplode(F.slice("path", F.lit(1), F.col("depth"))).alias("at", "id"))
    return below.select("id", "descendant", (F.col("depth") - F.col("at")).alias("distance"))


def hierarchy_table(resolved: DataFrame, rows_per_task: int = 200_000) -> DataFrame:
    """The resolved nodes with the number of their descendants."""
    scratch = Scratch(resolved.sparkSession, "descendants")
    resolved = scratch.write(resolved, "resolved")
    forest = resolved.where("cycle_id IS NULL").select("id", F.when(F.col("depth") > 0, F.element_at("path", F.col("depth"))).alias("parent"), F.lit(1).cast("bigint").alias("weight"))
    counts = subtree_totals(forest, scratch, rows_per_task).select("id", (F.col("total") - 1).alias("n_descendants"))
    return resolved.join(counts, "id", "left")
