"""Bounded traversals over edge tables (_from, _to), as joins.

The rule for uniqueness: a path uses no edge twice; vertices may repeat. A traversal returns one row for each path.
Each step is one equi-join on the frontier's last vertex, which Spark shuffles, broadcasts or splits by size; hub vertices are
left to adaptive skew handling.

Each row of an edge table is an edge of its own. With a column _key that is its identity (rows without a key are told apart
by their ends only); without that column rows are numbered, in a copy in the shared folder, so that the numbers stay.
"""

from __future__ import annotations

from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import InvalidArgumentError, NotFoundError
from ..sources.store import written

if TYPE_CHECKING:
    from ..sources.catalog import Engine


def _directed(edges: DataFrame, direction: str) -> DataFrame:
    if direction not in ("outbound", "inbound", "any"):
        raise InvalidArgumentError(f"direction {direction!r} is not outbound, inbound or any")
    there = edges.filter("_from is not null and _to is not null")
    ends = [F.col("_from").alias("_a"), F.col("_to").alias("_b")]
    if "_key" in edges.columns:
        out = there.select(*ends, F.coalesce(F.concat(F.lit("k"), "_key"), F.to_json(F.struct("_from", "_to"))).alias("_e"))
    else:
        out = written(there.select(*ends, F.monotonically_increasing_id().cast("string").alias("_e")))
    back = out.select(F.col("_b").alias("_a"), F.col("_a").alias("_b"), "_e")
    return out.unionByName(back) if direction == "any" else back if direction == "inbound" else out


def _starts(starts: DataFrame, start: str) -> DataFrame:
    return starts.select(F.col(start).alias("start")).filter("start is not null").distinct()


def traverse(edges: DataFrame, starts: DataFrame, start: str, least: int = 1, most: int = 1, direction: str = "outbound") -> DataFrame:
    """(start, vertex, depth, path) for all paths of `least` to `most` edges. starts: a table with the start vertices."""
    if least < 0 or most < least:
        raise InvalidArgumentError("depths must be 0 <= least <= most")
    steps = _directed(edges, direction)
    front = _starts(starts, start).select("start", F.col("start").alias("vertex"), F.lit(0).alias("depth"), F.array("start").alias("path"), F.array().cast("array<string>").alias("_used"))
    out = front if least == 0 else None
    for k in range(1, most + 1):
        front = front.join(steps, F.col("vertex") == F.col("_a")).filter(~F.array_contains("_used", F.col("_e")))
        front = front.select("start", F.col("_b").alias("vertex"), F.lit(k).alias("depth"), F.concat("path", F.array("_b")).alias("path"), F.concat("_used", F.array("_e")).alias("_used"))
        if k >= least:
            out = front if out is None else out.unionByName(front)
    return out.drop("_used")


def neighbors(edges: DataFrame, starts: DataFrame, start: str, most: int = 1, direction: str = "outbound") -> DataFrame:
    """(start, vertex, depth): each vertex once for each start, at its smallest depth. The frontier holds a vertex once,
    so hubs and cycles cost no more than their edges. Each level is written to the shared folder, so that plans stay
    small, and the search ends with the first empty level."""
    steps = written(_directed(edges, direction).select("_a", "_b").distinct())
    seen = _starts(starts, start).select("start", F.col("start").alias("vertex"), F.lit(0).alias("depth"))
    front = seen = written(seen)
    for k in range(1, most + 1):
        next_ = front.join(steps, F.col("vertex") == F.col("_a")).select("start", F.col("_b").alias("vertex"), F.lit(k).alias("depth")).distinct()
        front = written(next_.join(seen.select("start", "vertex"), ["start", "vertex"], "left_anti").select("start", "vertex", "depth"))
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen


def shortest_paths(edges: DataFrame, starts: DataFrame, start: str, target: str, most: int, direction: str = "outbound") -> DataFrame:
    """(start, depth, path) for the starts that reach the vertex `target` in at most `most` edges; of several shortest paths
    the first in the order of their vertices. The search of a start ends when it has reached the target; frontier and
    visited vertices are held once, each level in the shared folder."""
    steps = written(_directed(edges, direction).select("_a", "_b").distinct())
    front = written(_starts(starts, start).select("start", F.col("start").alias("vertex"), F.array("start").alias("path")))
    seen, found = front.select("start", "vertex"), front.filter(F.col("vertex") == target)
    for _ in range(most):
        live = front.join(front.filter(F.col("vertex") == target).select("start"), "start", "left_anti")
        next_ = live.join(steps, F.col("vertex") == F.col("_a")).groupBy("start", F.col("_b").alias("vertex")).agg(F.min(F.concat("path", F.array("_b"))).alias("path"))
        front = written(next_.join(seen, ["start", "vertex"], "left_anti"))
        if front.isEmpty():
            break
        seen, found = seen.unionByName(front.select("start", "vertex")), found.unionByName(front.filter(F.col("vertex") == target))
    return found.select("start", (F.size("path") - 1).alias("depth"), "path")


def graph_edges(engine: Engine, database: str, graph: str) -> DataFrame:
    """(_key, _from, _to) of all edge collections of a named graph, as its document in the store's collection of graphs lists
    them; keys are told apart by collection."""
    tables = engine.databases.get(database, {})
    names: list[str] = []
    if "_graphs" in tables:
        listed = F.try_variant_get("doc", "$.edgeDefinitions", "array<struct<collection:string>>")
        mine = tables["_graphs"].documents().filter(F.try_variant_get("doc", "$._key", "string") == graph)
        names = [c["collection"] for r in mine.select(listed.alias("d")).limit(1).collect() for c in r["d"] or []]
    if not names:
        raise NotFoundError(f"graph {graph} does not exist in {database}")
    parts = [engine.table(database, n, ["_key", "_from", "_to"]).withColumn("_key", F.concat(F.lit(f"{n}/"), "_key")) for n in sorted(set(names))]
    return reduce(DataFrame.unionByName, parts)
