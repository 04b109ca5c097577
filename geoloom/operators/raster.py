"""Statistics of image bands, palettes, and regions of equal pixels with their outlines.

Regions grow from runs of equal pixels: runs that meet are linked, links give components, and the runs of a component are
boxes whose outline cancels out of their sides. A raster may come whole or in blocks of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.functions.polygons import simplified
from geoloom.operators.graph import connected_components
from geoloom.operators.outline import PART, shapes
from geoloom.storage import stored


def band_stats(images: DataFrame, key: str, band: str, pixels: str) -> DataFrame:
    """(key, band, mean, std): population statistics of each band's pixels, rounded half-even to three digits."""
    v = F.transform(F.col(pixels), lambda x: x.cast("double"))
    n = F.size(v)
    mean = F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / n
    out = images.select(key, band, v.alias("v"), mean.alias("m"))
    var = F.aggregate(F.col("v"), F.lit(0.0), lambda s, x: s + (x - F.col("m")) * (x - F.col("m"))) / F.size("v")
    return out.select(key, band, F.bround("m", 3).alias("mean"), F.bround(F.sqrt(var), 3).alias("std"))


def summary_stats(stats: DataFrame, band: str) -> DataFrame:
    """Medians over all images of each band's mean and deviation, to two digits."""
    return stats.groupBy(band).agg(F.bround(F.median("mean"), 2).alias("mean"), F.bround(F.median("std"), 2).alias("std"))


def apply_palette(pixels: Column, palette: Column) -> Column:
    """Colours of palette indices from 0; an index outside gives null."""
    return F.transform(pixels, lambda p: F.get(palette, p))


def clear_nodata(palette: Column, nodata: int = 255) -> Column:
    """A palette of colours (red, green, blue, opacity) whose colour of nodata is clear: zeros."""
    return F.transform(palette, lambda c, k: F.when(k == nodata, F.transform(c, lambda v: v * 0)).otherwise(c))


#: Columns of a raster that are worked on together where runs of neighbouring rows meet.
STRETCH = 256


def runs(rasters: DataFrame, key: str, rows: str = "rows", top: str | None = None, left: str | None = None) -> DataFrame:
    """(key, value, y, a, b): the longest runs of equal pixels, columns a to b (excluded) of row y from the top.

    rows is an array of arrays, the whole raster or a block of it whose first row and column top and left give. Null
    rasters, rows and pixels have no run.
    """
    offset = lambda c: F.col(c).cast("long") if c else F.lit(0).cast("long")
    lines = rasters.select(key, offset(top).alias("top"), offset(left).alias("left"), F.posexplode(rows).alias("line", "pixels"))
    n = F.size("pixels")
    first = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | ~F.get("pixels", i).eqNullSafe(F.get("pixels", i - 1)))
    found = lines.where(n > 0).select(key, (F.col("top") + F.col("line")).alias("y"), "left", "pixels", first.alias("first"), n.alias("n"))
    pairs = F.zip_with("first", F.concat(F.slice("first", F.lit(2), F.size("first")), F.array("n")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    each = found.select(key, "y", "left", "pixels", F.explode(pairs).alias("r"))
    return each.select(key, F.get("pixels", F.col("r.a")).alias("value"), "y", (F.col("left") + F.col("r.a")).alias("a"), (F.col("left") + F.col("r.b")).alias("b")).where("value IS NOT NULL")


def regions(found: DataFrame, key: str) -> DataFrame:
    """(key, value, y, a, b, region): runs with the number of their region, from 0 in each raster by its first pixel.

    Runs of one value belong together where they meet along a side, in neighbouring rows or at the border of two blocks.
    """
    named = stored(found.withColumn("id", F.monotonically_increasing_id()))
    stretch = F.explode(F.sequence(F.expr(f"a div {STRETCH}"), F.expr(f"(b - 1) div {STRETCH}"))).alias("s")
    upper = named.select(F.col(key).alias("_k"), F.col("value").alias("_v"), (F.col("y") + 1).alias("_y"), F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("id").alias("_id"))
    lower = named.select(key, "value", "y", "a", "b", "id", stretch)
    above = upper.withColumnsRenamed({"_a": "a", "_b": "b"}).select("_k", "_v", "_y", F.col("a").alias("_a"), F.col("b").alias("_b"), "_id", stretch.alias("_s"))
    same = F.col(key).eqNullSafe(F.col("_k")) & (F.col("value") == F.col("_v")) & (F.col("y") == F.col("_y"))
    met = lower.join(above, same & (F.col("s") == F.col("_s")) & (F.col("a") < F.col("_b")) & (F.col("_a") < F.col("b"))).select("id", "_id")
    beside = named.join(upper.withColumn("_y", F.col("_y") - 1), same & (F.col("a") == F.col("_b"))).select("id", "_id")
    parts = connected_components(met.unionByName(beside), "id", "_id").select(F.col("node").alias("id"), "component")
    owned = named.join(parts, "id", "left").withColumn("component", F.coalesce("component", "id"))
    first = owned.groupBy(key, "component").agg(F.min(F.struct("y", "a")).alias("first"))
    numbered = first.withColumn("region", F.row_number().over(Window.partitionBy(key).orderBy("first")) - 1)
    return owned.join(numbered.select("component", "region"), "component").select(key, "value", "y", "a", "b", "region")


def region_boxes(found: DataFrame, key: str) -> DataFrame:
    """(key, region, value, area, x0, y0, x1, y1): pixels and bounds of the regions of regions()."""
    sides = (F.min("a").alias("x0"), F.min("y").alias("y0"), F.max("b").alias("x1"), (F.max("y") + 1).alias("y1"))
    return found.groupBy(key, "region").agg(F.first("value").alias("value"), F.sum(F.col("b") - F.col("a")).alias("area"), *sides)


def mask_boxes(masks: DataFrame, key: str, rows: str = "rows") -> DataFrame:
    """(key, region, area, x0, y0, x1, y1) of the regions of ones, joined by edges, of each mask (an array of arrays)."""
    return region_boxes(regions(runs(masks, key, rows).where("value = 1"), key), key).drop("value")


def outlines(found: DataFrame, key: str, placed: DataFrame | None = None, epsilon: float | None = None) -> DataFrame:
    """(key, region, value, polygon, area): the outlines of the regions of regions(), with holes.

    placed gives, for each key, x0 and y1 of the raster's upper left corner and the width dx and height dy of a pixel;
    without it the corner is the origin and a pixel is 1 by 1, so y is negative. With epsilon rings are simplified, no point
    that goes lying further off; area stays that of the pixels.
    """
    box = {PART[0]: F.col("a"), PART[1]: -F.col("y") - 1, PART[2]: F.col("b"), PART[3]: -F.col("y")}
    parts = found.select(key, "region", "value", F.lit(0).alias("part"), *(c.cast("double").alias(n) for n, c in box.items()))
    drawn = shapes(parts, [key, "region", "value"]).drop("part")  # a region is one piece
    if placed is not None:
        x = lambda p: F.col("x0") + p["x"] * F.col("dx")
        y = lambda p: F.col("y1") + p["y"] * F.col("dy")
        moved = F.transform("polygon", lambda r: F.transform(r, lambda p: F.struct(x(p).alias("x"), y(p).alias("y"))))
        at = placed.select(F.col(key).alias("_key"), "x0", "y1", "dx", "dy")
        drawn = drawn.join(at, F.col(key).eqNullSafe(F.col("_key"))).select(key, "region", "value", moved.alias("polygon"), (F.col("area") * F.col("dx") * F.col("dy")).alias("area"))
    if epsilon is not None:
        rings = drawn.select(key, "region", "value", "area", F.posexplode("polygon").alias("n", "ring")).withColumn("ring", simplified(epsilon)(F.col("ring")))
        drawn = rings.groupBy(key, "region", "value", "area").agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "ring"))), lambda r: r["ring"]).alias("polygon"))
    return drawn.select(key, "region", "value", "polygon", "area")


def nodata_polygons(rasters: DataFrame, key: str, nodata: int, placed: DataFrame | None = None, least_area: float = 10, **blocks: str) -> DataFrame:
    """(key, id_nodata_poly, polygon, area) of the regions of nodata pixels with more than least_area, numbered before that."""
    found = regions(runs(rasters, key, **blocks).where(F.col("value") == nodata), key)
    return outlines(found, key, placed).where(F.col("area") > least_area).select(key, F.col("region").alias("id_nodata_poly"), "polygon", "area")
