"""Polygons cut by boxes: clipped parts, covered shares, and boxes that lie whole in a polygon.

A polygon is a ring column, without holes and without crossing itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.geometry import Box, ring_area, scaled_box
from geoloom.functions.polygons import clipped
from geoloom.operators.spatial import spatial_join

BOUNDS = ("_r0", "_r1", "_r2", "_r3")


def with_bounds(df: DataFrame, ring: str) -> DataFrame:
    """df with the bounds of its rings."""
    x, y = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return df.withColumns(dict(zip(BOUNDS, (F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y)), strict=True)))


def clip_polygons(polygons: DataFrame, ring: str, tiles: DataFrame, box: Box, scale: float = 1.0, cell: float = 128, levels: int = 1, also: Column | None = None) -> DataFrame:
    """Pairs of polygon and tile, a row for each part of the polygon inside the tile scaled about its centre.

    Columns of both sides (names must differ), part from 0, its ring in place of the whole one, and part_area. Pairs that
    only touch, null rings and rings without area give no row. also is a condition on pairs, on BOUNDS and box.
    """
    pairs = spatial_join(with_bounds(polygons, ring), BOUNDS, tiles, box, cell, also=also, levels=levels).drop(*BOUNDS)
    window = scaled_box(box, scale) if scale != 1.0 else [F.col(c) for c in box]
    parts = pairs.select(*(c for c in pairs.columns if c != ring), F.posexplode(clipped(F.col(ring), *window)).alias("part", ring))
    return parts.withColumn("part_area", ring_area(F.col(ring)))


def boxes_in_polygons(boxes: DataFrame, box: Box, key: str, polygons: DataFrame, ring: str, cell: float = 128, how: str = "left_semi") -> DataFrame:
    """The boxes that lie whole in one polygon, or with how="left_anti" those that lie in none, such as tiles on a lake.

    A box lies in a polygon if its part there has the box's area, but for a share of 1e-9. Polygons are cut only by boxes
    that lie in their bounds.
    """
    x0, y0, x1, y1 = map(F.col, box)
    r0, s0, r1, s1 = map(F.col, BOUNDS)
    w, h = (x1 - x0) * 1e-6, (y1 - y0) * 1e-6
    bounded = (x0 + w >= r0) & (y0 + h >= s0) & (x1 - w <= r1) & (y1 - h <= s1)
    parts = clip_polygons(polygons.select(ring, F.monotonically_increasing_id().alias("_polygon")), ring, boxes.select(key, *box), box, cell=cell, also=bounded)
    met = parts.where(F.col("part_area") >= (x1 - x0) * (y1 - y0) * (1 - 1e-9)).select(key).distinct()
    return boxes.join(met, key, how)
