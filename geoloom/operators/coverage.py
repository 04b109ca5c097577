"""Areas that boxes cover together, and shares of boxes that others leave uncovered; all from boxes cut at grid cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoloom.functions.geometry import Box, box_area, box_intersection
from geoloom.operators.spatial import spatial_join


def union_area(df: DataFrame, box: Box, by: Sequence[str] = (), cell: float = 256) -> DataFrame:
    """(by..., area): the area that the boxes of each group cover, overlaps counted once; boxes without area add nothing.

    Boxes are cut at grid cells; in a cell they are cut into strips at all their sides, and in a strip the intervals above
    each other merge in one pass.
    """
    at = lambda c: F.floor(F.col(c) / cell).cast("long")
    boxes = df.where(F.col(box[2]) > F.col(box[0])).where(F.col(box[3]) > F.col(box[1])).select(*by, *box)
    cells = boxes.withColumn("_cx", F.explode(F.sequence(at(box[0]), at(box[2])))).withColumn("_cy", F.explode(F.sequence(at(box[1]), at(box[3]))))
    cut = [F.greatest(F.col(box[0]), F.col("_cx") * cell), F.greatest(F.col(box[1]), F.col("_cy") * cell), F.least(F.col(box[2]), (F.col("_cx") + 1) * cell), F.least(F.col(box[3]), (F.col("_cy") + 1) * cell)]
    group = [*by, "_cx", "_cy"]
    parts = cells.select(*group, *(c.cast("double").alias(n) for c, n in zip(cut, ("_x0", "_y0", "_x1", "_y1"), strict=True))).where("_x1 > _x0 AND _y1 > _y0").distinct()
    sides = parts.select(*group, F.explode(F.array("_x0", "_x1")).alias("_s")).distinct()
    line = Window.partitionBy(*group).orderBy("_s")
    strips = sides.withColumn("_t", F.lead("_s").over(line)).where("_t IS NOT NULL")
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"q.{c}")) for c in group]
    # Merged, here and below: estimates don't count the rows that a cell or side adds, so the planner would send large sides to the driver.
    met = strips.alias("p").join(parts.hint("merge").alias("q"), [*same, F.col("q._x0") <= F.col("p._s"), F.col("q._x1") >= F.col("p._t")])
    met = met.select(*(f"p.{c}" for c in group), "p._s", "p._t", "q._y0", "q._y1")
    rising = Window.partitionBy(*group, "_s").orderBy("_y0", "_y1").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("_y1").over(rising), F.col("_y0"))
    height = F.greatest(F.col("_y1") - F.greatest(F.col("_y0"), reached), F.lit(0.0))
    return met.withColumn("_area", height * (F.col("_t") - F.col("_s"))).groupBy(*by).agg(F.sum("_area").alias("area"))


def uncovered(cells: DataFrame, cell_box: Box, key: str, cover: DataFrame, cover_box: Box, on: Sequence[tuple[str, str]] = (), cell: float = 128) -> DataFrame:
    """(key, share): the share of each cell that no box of cover, of equal columns on, covers; without area it is null."""
    pairs = spatial_join(cells.select(key, *cell_box, *(a for a, _ in on)), cell_box, cover.select(*cover_box, *(b for _, b in on)), cover_box, cell, on)
    inner = dict(zip(("_i0", "_i1", "_i2", "_i3"), box_intersection(cell_box, cover_box), strict=True))
    covered = union_area(pairs.withColumns(inner), tuple(inner), [key])
    own = cells.select(key, box_area(cell_box).alias("_own")).join(covered.hint("merge"), key, "left")
    share = F.when(F.col("_own") > 0, F.greatest(F.lit(0.0), 1 - F.coalesce("area", F.lit(0.0)) / F.col("_own")))
    return own.select(key, share.alias("share"))


def coverage_test(shares: DataFrame, limit: float, larger: bool = True) -> DataFrame:
    """Cells with an uncovered share above limit, or with larger=False at most limit; fully covered ones never pass."""
    open_ = shares.where("share > 0")
    return open_.where(F.col("share") > limit) if larger else open_.where(F.col("share") <= limit)
