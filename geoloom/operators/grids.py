"""Grids of tiles: covers of boxes in Web Mercator, tiling jobs, and pixel grids with overlap, padding and two levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.config import check_empty_years, check_false_years
from geoloom.functions.boxes import unite
from geoloom.functions.geometry import Box, mercator_tile, tile_degrees
from geoloom.operators.coverage import coverage_test, uncovered
from geoloom.operators.outline import PART, TABLES, UNION
from geoloom.storage import cut_lineage

DEGREES = ("west", "south", "east", "north")
CELL_BOX = ("c_x0", "c_y0", "c_x1", "c_y1")
HOLE_BOX = ("n_x0", "n_y0", "n_x1", "n_y1")
#: Boxes of nodata that the row of an image may hold.
HOLES = 256


def cover(boxes: DataFrame, zoom: int, year: str | None = None) -> DataFrame:
    """Distinct (x, y, id) of the tiles that cover boxes of degrees (west, south, east, north), with year of each year apart."""
    keep = [year] if year else []
    left, top = mercator_tile(F.col("west"), F.col("north"), zoom)
    right, low = mercator_tile(F.col("east"), F.col("south"), zoom)
    tiles = boxes.select(*keep, F.explode(F.sequence(left, right)).alias("x"), top.alias("top"), low.alias("low")).select(*keep, "x", F.explode(F.sequence("top", "low")).alias("y"))
    return tiles.distinct().withColumn("id", F.format_string(f"({'%d, ' if year else ''}%d, %d, {zoom})", *keep, "x", "y"))


def tiling(labels: DataFrame, zoom: int, fp: DataFrame | None = None, empty: DataFrame | None = None, empty_year: int | None = None) -> DataFrame:
    """The tiles over labels, false positives and areas for empty tiles, all boxes of degrees, each id once.

    (id, x, y, year if labels have one, west..north, labelled, fp): labelled tiles meet a label or false positive of any
    year, fp tiles a false positive. Areas without a year of their own take empty_year. Rows with a null side give none.
    """
    year = "year" if "year" in labels.columns else None
    columns = [*DEGREES, *([year] if year else [])]
    if fp is not None:
        check_false_years(labels.columns, fp.columns)
    every = labels.select(*columns) if fp is None else labels.select(*columns).unionByName(fp.select(*columns))
    tiles = cover(every, zoom, year)
    if empty is not None:
        check_empty_years(labels.columns, empty.columns, empty_year)
        if year and "year" not in empty.columns:
            empty = empty.withColumn("year", F.lit(empty_year))
        tiles = tiles.unionByName(cover(empty.select(*columns), zoom, year)).distinct()
    for name, boxes in (("labelled", every), ("fp", fp)):
        if boxes is None:
            tiles = tiles.withColumn(name, F.lit(False))
        else:
            met = cover(boxes, zoom).select("x", "y", F.lit(True).alias("_met"))
            tiles = tiles.join(met, ["x", "y"], "left").withColumn(name, F.coalesce("_met", F.lit(False))).drop("_met")
    return tiles.withColumns(dict(zip(DEGREES, tile_degrees(F.col("x"), F.col("y"), zoom), strict=True)))


def _cells(size: Column, side: int, overlap: int) -> Column:
    return F.greatest(F.lit(1), F.ceil((size - overlap) / (side - overlap))).cast("int")


def pixel_grid(images: DataFrame, width: str, height: str, side: int, overlap: int) -> DataFrame:
    """images with (col, row, px0, py0): ceil((size - overlap) / (side - overlap)) cells a side."""
    step = side - overlap
    n = lambda c: _cells(F.col(c), side, overlap)
    wide = images.withColumn("col", F.explode(F.sequence(F.lit(0), n(width) - 1)))
    cells = wide.withColumn("row", F.explode(F.sequence(F.lit(0), n(height) - 1)))
    return cells.withColumn("px0", F.col("col") * step).withColumn("py0", F.col("row") * step)


def world_grid(images: DataFrame, box: Box, width: str, height: str, pixel: str, side: int, overlap: int = 0) -> DataFrame:
    """pixel_grid() with the cells' boxes in the world (c_x0..c_y1), from the lower left corner; the last ones jut out."""
    at = lambda low, px, more=0: F.col(low) + (F.col(px) + more) * F.col(pixel)
    sides = (at(box[0], "px0"), at(box[1], "py0"), at(box[0], "px0", side), at(box[1], "py0", side))
    return pixel_grid(images, width, height, side, overlap).withColumns(dict(zip(CELL_BOX, sides, strict=True)))


# The numbers of the strips above and to the right of an image.
ABOVE, RIGHT = 10001, 10002


def padding(images: DataFrame, box: Box, key: str, width: str, height: str, pixel: str, side: int = 256, overlap: int = 0) -> DataFrame:
    """(key, id_nodata_poly, n_x0..n_y1): the strips above and right of each image that a grid of side covers beyond it.

    The upper strip is as wide as both; a grid that ends with the image gives strips of no area.
    """
    x0, y0, x1, y1 = map(F.col, box)
    more = lambda c: (_cells(F.col(c), side, overlap) * (side - overlap) + overlap - F.col(c)) * F.col(pixel)
    right, top = x1 + more(width), y1 + more(height)
    strip = lambda number, *b: F.struct(F.lit(number).alias("id_nodata_poly"), *(c.alias(n) for c, n in zip(b, HOLE_BOX, strict=True)))
    return images.select(key, F.inline(F.array(strip(ABOVE, x0, y1, right, top), strip(RIGHT, x1, y0, right, y1))))


def sub_tiles(
    images: DataFrame, box: Box, key: str, width: str, height: str, pixel: str, nodata: DataFrame,
    sides: tuple[int, int] = (512, 256), limits: tuple[float, float] = (0.5, 0.25), least_area: float = 10, cell: float = 128,
) -> DataFrame:
    """(key, id, side, c_x0..c_y1): large cells of each image, and small ones where no large one is, cut at the image.

    nodata has key and boxes n_x0..n_y1 of the image of that key, and may overlap. A large cell stays if it leaves open
    more than the first limit of its area; a small one if more than least_area of it lies off the large ones and nodata
    leaves open more than the second limit of that part.

    An image with up to HOLES boxes of nodata has them united in its row, where its cells are tried; others go by joins.
    """
    holes = nodata.select(F.col(key).alias("_image"), *HOLE_BOX).where("n_x1 > n_x0 AND n_y1 > n_y0")
    images = images.select(key, *box, width, height, pixel)
    full = cut_lineage(holes.groupBy("_image").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOLES).select(F.col("_image").alias(key)))
    some = not full.isEmpty()
    few = _tried(images.join(full.hint("merge"), key, "left_anti") if some else images, box, key, width, height, pixel, holes, sides, limits, least_area)
    if some:
        few = few.unionByName(_joined(images.join(full.hint("merge"), key, "left_semi"), box, key, width, height, pixel, holes, sides, limits, least_area, cell))
    whole = lambda c: F.bround(c).cast("long")
    number = F.format_string("(%d, %d, %s)", whole("c_x0"), whole("c_y0"), F.col(key).cast("string"))
    cut = {"c_x1": F.least("c_x1", box[2]), "c_y1": F.least("c_y1", box[3])}
    return few.withColumn("id", number).withColumns(cut).select(key, "id", "side", *CELL_BOX)


def _tried(images: DataFrame, box: Box, key: str, width: str, height: str, pixel: str, holes: DataFrame, sides: tuple[int, int], limits: tuple[float, float], least_area: float) -> DataFrame:
    """(images..., side, c_x0..c_y1): the cells of sub_tiles(), tried in the row of their image."""
    each = F.struct(F.lit(False).alias("second"), *(F.col(c).cast("double").alias(n) for c, n in zip(HOLE_BOX, PART, strict=True)))
    own = holes.groupBy("_image").agg(F.collect_set(each).alias("_b")).select("_image", unite(TABLES[UNION])("_b").alias("_holes"))
    joined = images.join(own.hint("merge"), F.col(key) == F.col("_image"), "left").drop("_image").withColumn("_holes", F.coalesce("_holes", F.array().cast(own.schema["_holes"].dataType)))
    at = lambda low, px, more=0: (F.col(low) + (px + more) * F.col(pixel)).cast("double")

    def grid(side: int) -> Column:
        span = lambda size: F.sequence(F.lit(0), _cells(F.col(size), side, 0) - 1)
        one = lambda c, r: F.struct(*(v.alias(n) for v, n in zip((at(box[0], c * side), at(box[1], r * side), at(box[0], c * side, side), at(box[1], r * side, side)), CELL_BOX, strict=True)))
        return F.flatten(F.transform(span(width), lambda c: F.transform(span(height), lambda r: one(c, r))))

    def common(*boxes: list[Column]) -> Column:
        wide, high = (F.least(*(b[k + 2] for b in boxes)) - F.greatest(*(b[k] for b in boxes)) for k in (0, 1))
        return F.greatest(wide, F.lit(0.0)) * F.greatest(high, F.lit(0.0))

    c, h = lambda v: [v[n] for n in CELL_BOX], lambda v: [v[n] for n in PART]
    total = lambda values, f: F.aggregate(values, F.lit(0.0), lambda s, v: s + f(v))
    area = lambda b: (b[2] - b[0]) * (b[3] - b[1])
    share = lambda covered, b: F.greatest(F.lit(0.0), 1 - F.try_divide(covered, area(b)))
    open_ = lambda v: share(total("_holes", lambda o: common(c(v), h(o))), c(v))
    large = joined.withColumn("_large", F.filter(grid(sides[0]), lambda v: (open_(v) > 0) & (open_(v) > limits[0])))
    own_box = [F.col(n) for n in CELL_BOX]
    marked = lambda cells, k: F.transform(cells, lambda v: F.struct(F.lit(sides[k]).alias("side"), F.lit(k == 0).alias("_kept"), *(v[n].alias(n) for n in CELL_BOX)))
    small = large.withColumn("_v", F.explode(F.concat(marked(F.col("_large"), 0), marked(grid(sides[1]), 1)))).select(*images.columns, "_holes", "_large", "_v.*")
    # Large cells don't overlap each other, and neither do united holes: what both cover is their sums less what they share.
    small = small.withColumn("_over", F.filter("_large", lambda v: common(c(v), own_box) > 0)).withColumn("_under", total("_over", lambda v: common(c(v), own_box)))
    both = total("_over", lambda v: total("_holes", lambda o: common(c(v), h(o), own_box)))
    small = small.withColumn("_covered", F.col("_under") + total("_holes", lambda o: common(h(o), own_box)) - both)
    off = share(F.col("_under"), own_box)
    free = (off * area(own_box) > least_area) & (share(F.col("_covered"), own_box) > off * limits[1])
    return small.where(F.col("_kept") | free).select(*images.columns, "side", *CELL_BOX)


def _joined(images: DataFrame, box: Box, key: str, width: str, height: str, pixel: str, holes: DataFrame, sides: tuple[int, int], limits: tuple[float, float], least_area: float, cell: float) -> DataFrame:
    """The same for images of any amount of nodata."""

    def level(k: int) -> DataFrame:
        cells = world_grid(images, box, width, height, pixel, sides[k])
        return cells.withColumn("_cell", F.struct(key, "col", "row")).withColumn("side", F.lit(sides[k]))

    free = lambda cells, cover: uncovered(cells, CELL_BOX, "_cell", cover, HOLE_BOX, [(key, "_image")], cell)
    large, small = level(0), level(1)
    large = cut_lineage(large.join(coverage_test(free(large, holes), limits[0]).select("_cell").hint("merge"), "_cell", "left_semi"))  # read three times
    under = large.select(F.col(key).alias("_image"), *(F.col(c).alias(n) for c, n in zip(CELL_BOX, HOLE_BOX, strict=True)))
    off = free(small, under).withColumnRenamed("share", "_off")
    open_ = free(small, holes.unionByName(under)).withColumnRenamed("share", "_open")
    small = small.join(off.hint("merge"), "_cell").join(open_.hint("merge"), "_cell")
    area = (F.col("c_x1") - F.col("c_x0")) * (F.col("c_y1") - F.col("c_y0"))
    small = small.where((F.col("_off") * area > least_area) & (F.col("_open") > F.col("_off") * limits[1])).drop("_off", "_open")
    return large.unionByName(small).select(*images.columns, "side", *CELL_BOX)
