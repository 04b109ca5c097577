"""Connected components of an edge table of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions import chains
from geoloom.storage import stored


def _with_minimum(directed: DataFrame) -> DataFrame:
    """Rows (u, v) with m, the least of u and its neighbours."""
    least = directed.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return directed.join(least, "u")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", near: bool = False, max_rounds: int = 100) -> DataFrame:
    """(node, component): the least node that each node of the edges reaches.

    Alternating large-star and small-star steps: each keeps at most as many edges as it got, and a hub's edges are
    spread over tasks as a skewed join. Each round is a table of its own. Null ends and self-loops add no node;
    an empty edge table gives an empty result.

    With near, nodes are numbers, best such that lie close together where they are linked, as ids of neighbouring boxes do: each
    task first finds what its own edges link and writes an edge for each of its nodes at most, and rounds are needed only for what lies in several tasks, so not for as few
    edges as one may hold (chains.ROWS).
    """
    now = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v")
    linked = lambda df: df.mapInArrow(chains.in_chunks(chains.stars), df.schema)
    now = stored(linked(now) if near else now.distinct())
    seen = None
    if near and now.count() <= chains.ROWS:
        now, max_rounds = stored(linked(now.coalesce(1))), 0
    elif near:
        now = now.repartitionByRange("u")
    for left in reversed(range(max_rounds)):
        if near:
            now = linked(now)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        joined = _with_minimum(down)
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            joined.select("u", F.col("m").alias("v"))
        )
        now = stored(small.where("u <> v").distinct())
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        if not left:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        seen = mark
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
