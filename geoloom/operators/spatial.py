"""Spatial joins of boxes as equi-joins on grid cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.geometry import Box, boxes_intersect
from geoloom.storage import stored

CELL = 64
#: Share of the sides of boxes that is looked at first where only some pair is asked for.
CORE = 0.2


def _cells(df: DataFrame, box: Box, cell: float, cx: str, cy: str) -> DataFrame:
    at = lambda c: F.floor(F.col(c) / cell).cast("long")
    wide = df.withColumn(cx, F.explode(F.sequence(at(box[0]), at(box[2]))))
    return wide.withColumn(cy, F.explode(F.sequence(at(box[1]), at(box[3]))))


#: Sides of cells of one level in those of the level below.
RATIO = 8


def _placed(df: DataFrame, box: Box, cell: float, levels: int, level: str, cx: str, cy: str, own: str) -> DataFrame:
    """df with a row for each cell of its boxes on their own level and on all above it; own marks the first.

    A box's own level is the lowest on which it is no longer than RATIO cells, so it covers RATIO + 1 squared there at most,
    and four on each level above; only on the highest level there may be more.
    """
    long = F.greatest(F.col(box[2]) - F.col(box[0]), F.col(box[3]) - F.col(box[1]))
    first = F.lit(levels - 1)
    for k in reversed(range(levels - 1)):
        first = F.when(long <= cell * RATIO ** (k + 1), k).otherwise(first)
    each = df.withColumn(level, F.explode(F.sequence(first, F.lit(levels - 1)))).withColumn(own, F.col(level) == first)
    size = F.lit(float(cell)) * F.pow(F.lit(float(RATIO)), F.col(level))
    at = lambda c: F.floor(F.col(c) / size).cast("long")
    wide = each.withColumn(cx, F.explode(F.sequence(at(box[0]), at(box[2]))))
    return wide.withColumn(cy, F.explode(F.sequence(at(box[1]), at(box[3]))))


def _levelled_join(left: DataFrame, left_box: Box, right: DataFrame, right_box: Box, cell: float, on: Sequence[tuple[str, str]], also: Column | None, levels: int) -> DataFrame:
    """spatial_join() where a pair meets on the higher one of its boxes' own levels."""
    a, b = _placed(left, left_box, cell, levels, "_cl", "_cx", "_cy", "_co"), _placed(right, right_box, cell, levels, "_rl", "_rx", "_ry", "_ro")
    joined = (F.col("_cl") == F.col("_rl")) & (F.col("_cx") == F.col("_rx")) & (F.col("_cy") == F.col("_ry")) & (F.col("_co") | F.col("_ro"))
    for x, y in on:
        joined &= F.col(x).eqNullSafe(F.col(y))
    size = F.lit(float(cell)) * F.pow(F.lit(float(RATIO)), F.col("_cl"))
    corner = lambda k: F.floor(F.greatest(left_box[k], right_box[k]) / size)
    joined &= boxes_intersect(left_box, right_box) & (corner(0) == F.col("_cx")) & (corner(1) == F.col("_cy"))
    if also is not None:
        joined &= also
    return a.join(b.hint("merge"), joined).drop("_cl", "_cx", "_cy", "_co", "_rl", "_rx", "_ry", "_ro")


def spatial_join(left: DataFrame, left_box: Box, right: DataFrame, right_box: Box, cell: float = CELL, on: Sequence[tuple[str, str]] = (), also: Column | None = None, levels: int = 1) -> DataFrame:
    """All pairs whose boxes intersect (touching included), each once; column names of the sides must differ.

    A pair meets in every cell both cover and is kept in the one that holds the lower corner of the common part, so no
    distinct is needed. on lists further equal columns (null equals null). Rows with a null side have no pair. The
    cell should be about twice the usual box; larger boxes cost a row for each cell they cover. With more levels boxes of any
    size up to RATIO ** levels cells cost a bounded number of rows: each is placed by its size, and a row more on each level
    above it. Both sides are dealt out by cell, also where one is small: with a broadcast, a few tasks that read the other
    would test all pairs, in one function too long for the JVM to compile.
    """
    if levels > 1:
        return _levelled_join(left, left_box, right, right_box, cell, on, also, levels)
    a, b = _cells(left, left_box, cell, "_cx", "_cy"), _cells(right, right_box, cell, "_rx", "_ry")
    joined = (F.col("_cx") == F.col("_rx")) & (F.col("_cy") == F.col("_ry"))
    for x, y in on:
        joined &= F.col(x).eqNullSafe(F.col(y))
    corner = lambda k: F.floor(F.greatest(left_box[k], right_box[k]) / cell)
    joined &= boxes_intersect(left_box, right_box) & (corner(0) == F.col("_cx")) & (corner(1) == F.col("_cy"))
    if also is not None:
        joined &= also
    return a.join(b.hint("merge"), joined).drop("_cx", "_cy", "_rx", "_ry")


def cores(df: DataFrame, box: Box, share: float, names: Box) -> DataFrame:
    """df with its boxes shrunk about their centres to a share of their sides, as names."""
    low, high = (1 + share) / 2, (1 - share) / 2
    mix = lambda a, b, near, far: (F.col(a) * near + F.col(b) * far).cast("double")
    sides = (mix(box[0], box[2], low, high), mix(box[1], box[3], low, high), mix(box[0], box[2], high, low), mix(box[1], box[3], high, low))
    return df.withColumns(dict(zip(names, sides, strict=True)))


#: Names of the cores of both sides.
LEFT_CORE, RIGHT_CORE = ("_a0", "_a1", "_a2", "_a3"), ("_b0", "_b1", "_b2", "_b3")


def core_join(left: DataFrame, left_box: Box, right: DataFrame, right_box: Box, share: float, cell: float = CELL, on: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """All pairs whose boxes intersect when both are shrunk to share, each once."""
    a, b = cores(left, left_box, share, LEFT_CORE), cores(right, right_box, share, RIGHT_CORE)
    return spatial_join(a, LEFT_CORE, b, RIGHT_CORE, cell * share, on).drop(*LEFT_CORE, *RIGHT_CORE)


def similar_join(left: DataFrame, left_box: Box, right: DataFrame, right_box: Box, iou: float, cell: float = CELL, on: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """All pairs whose IoU is iou or more, and some others, each once.

    Along each axis what two such boxes share is at least iou of what they span, so their centres lie no further apart than
    (1 - iou) / (1 + iou) of their mean side: shrunk to that share they still meet.
    """
    if iou <= 0:
        return spatial_join(left, left_box, right, right_box, cell, on)
    return core_join(left, left_box, right, right_box, (1 - iou) / (1 + iou) + 1e-6, cell, on)


def meeting_keys(left: DataFrame, left_box: Box, right: DataFrame, right_box: Box, key: str, cell: float = CELL, on: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """The keys of left that have a pair in spatial_join(). Boxes whose cores meet do, so that only the rest is joined whole."""
    names = [key, *left_box, *(x for x, _ in on)]
    near = stored(core_join(left.select(*names), left_box, right, right_box, CORE, cell, on).select(key).distinct())
    rest = left.select(*names).join(near, key, "left_anti")
    return near.unionByName(stored(spatial_join(rest, left_box, right, right_box, cell, on).select(key).distinct()))


def star_edges(boxes: DataFrame, box: Box, key: str, by: Sequence[str] = (), apart: str | None = None, step: float = 16) -> DataFrame:
    """(key, to): few pairs of boxes of equal by, and of different apart if given, that hold one point of a grid inside.

    Boxes around one point all meet, so each has an edge to the least of them of another apart: a row for each box and point.
    """
    inner = lambda low, high: F.sequence((F.floor(F.col(low) / step) + 1).cast("long"), (F.ceil(F.col(high) / step) - 1).cast("long"))
    holds = lambda low, high: F.floor(F.col(low) / step) + 1 <= F.ceil(F.col(high) / step) - 1
    some = boxes.where(holds(box[0], box[2]) & holds(box[1], box[3])).select(key, *by, *([apart] if apart else []), *box)
    at = some.withColumn("_px", F.explode(inner(box[0], box[2]))).withColumn("_py", F.explode(inner(box[1], box[3])))
    at = at.select(key, F.struct("_px", "_py", *by).alias("_p"), (F.struct(apart) if apart else F.struct(key)).alias("_apart"))
    if not apart:
        ends = at.groupBy("_p").agg(F.min(key).alias("to"))
        return at.join(ends, "_p").where(F.col(key) != F.col("to")).select(key, "to").repartition(key).distinct()
    kinds = at.groupBy("_p", "_apart").agg(F.min(key).alias("low"))
    # The least box of all and the least of another apart than its own.
    first = kinds.groupBy("_p").agg(F.min(F.struct("low", "_apart")).alias("a"))
    other = kinds.join(first, "_p").where(F.col("_apart") != F.col("a._apart")).groupBy("_p").agg(F.min("low").alias("b"), F.first("a").alias("a"))
    to = F.when(F.col("_apart") != F.col("a._apart"), F.col("a.low")).otherwise(F.col("b"))
    return at.join(other, "_p").select(key, to.alias("to")).repartition(key).distinct()


def mixed_pairs(boxes: DataFrame, box: Box, other: Box, key: str, group: str, by: Sequence[str] = (), keep: Sequence[str] = (), also: Column | None = None, cell: float = CELL) -> DataFrame:
    """(key, o_key, group, o_group) of pairs of equal by and different group whose boxes intersect; cells of one group are left out.

    also is a condition on the boxes, keep, and the second box's as other and o_keep.
    """
    placed = _cells(boxes.select(key, group, *by, *keep, *box), box, cell, "_cx", "_cy").withColumn("_c", F.struct("_cx", "_cy", *by)).drop(*by)
    mixed = placed.groupBy("_c").agg(F.min(group).alias("_low"), F.max(group).alias("_high")).where("_low <> _high").select("_c")
    left = placed.join(mixed, "_c", "left_semi")
    names = {**dict(zip(box, other, strict=True)), **{c: f"o_{c}" for c in (key, group, *keep)}}
    right = left.withColumnsRenamed({**names, "_c": "_o"}).drop("_cx", "_cy")
    corner = lambda k: F.floor(F.greatest(box[k], other[k]) / cell)
    joined = (F.col("_c") == F.col("_o")) & (F.col(group) < F.col(f"o_{group}")) & boxes_intersect(box, other) & (corner(0) == F.col("_cx")) & (corner(1) == F.col("_cy"))
    joined = joined & also if also is not None else joined
    return left.join(right.hint("merge"), joined).select(key, f"o_{key}", group, f"o_{group}")


def spatial_semi_join(left: DataFrame, left_box: Box, right: DataFrame, right_box: Box, key: str, cell: float = CELL, how: str = "left_semi") -> DataFrame:
    """The rows of left whose key meets a box of right, or with how="left_anti" those that meet none."""
    met = spatial_join(left.select(key, *left_box), left_box, right.select(*right_box), right_box, cell).select(key).distinct()
    return left.join(met, key, how)


def contained(left: DataFrame, left_box: Box, right: DataFrame, right_box: Box, key: str, cell: float = CELL, how: str = "left_semi") -> DataFrame:
    """The rows of left whose box lies whole in a box of right, or with how="left_anti" those that lie in none."""
    a, b = [F.col(c) for c in left_box], [F.col(c) for c in right_box]
    inside = (a[0] >= b[0]) & (a[1] >= b[1]) & (a[2] <= b[2]) & (a[3] <= b[3])
    met = spatial_join(left.select(key, *left_box), left_box, right.select(*right_box), right_box, cell, also=inside).select(key).distinct()
    return left.join(met, key, how)
