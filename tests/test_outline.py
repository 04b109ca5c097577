"""Outlines, overlays and buffers of boxes, regions of rasters, and merging across tiles, against unit cells in numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.operators import outline, post, raster

BOX = ("x0", "y0", "x1", "y1")
SIDE = 14


def cells_of(boxes):
    grid = np.zeros((SIDE, SIDE), bool)
    for x0, y0, x1, y1 in boxes:
        grid[x0:x1, y0:y1] = True
    return grid


def filled(polygons):
    """The unit cells whose middle lies in an odd number of rings, of polygons that must not overlap."""
    out = np.zeros((SIDE, SIDE), int)
    for rings in polygons:
        inside = np.zeros((SIDE, SIDE), bool)
        for ring in rings:
            for p, q in zip(ring[:-1], ring[1:], strict=True):
                if p.x == q.x:
                    low, high = sorted((int(p.y), int(q.y)))
                    inside[: int(p.x), low:high] ^= True
        out += inside
    assert out.max(initial=0) <= 1
    return out == 1


def area(ring):
    return sum(p.x * q.y - q.x * p.y for p, q in zip(ring[:-1], ring[1:], strict=True)) / 2


def pieces_of(grid):
    """Number of pieces that share sides, and of holes: bounded parts of the rest that share sides."""

    def parts(cells):
        left, n = {tuple(c) for c in np.argwhere(cells)}, 0
        while left:
            n, todo = n + 1, [left.pop()]
            while todo:
                x, y = todo.pop()
                for c in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                    if c in left:
                        left.remove(c)
                        todo.append(c)
        return n

    return parts(grid), parts(~np.pad(grid, 1)) - 1


def random_boxes(rng, n, groups=60):
    out = []
    for g in range(groups):
        for _ in range(rng.integers(1, n)):
            x, y = rng.integers(0, SIDE - 2, 2)
            out.append((int(g), int(x), int(y), int(min(SIDE, x + rng.integers(1, 6))), int(min(SIDE, y + rng.integers(1, 6)))))
    return out


def frame(spark, boxes, extra=""):
    return spark.createDataFrame(boxes, f"g int, x0 int, y0 int, x1 int, y1 int{extra}")


def test_outlines_enclose_the_same_cells(spark):
    rows = random_boxes(np.random.default_rng(1), 16)
    # Corners that touch, a ring that is shut only by a corner, a hole within a hole's island.
    rows += [(100, 0, 0, 1, 1), (100, 1, 1, 2, 2), (101, 0, 0, 3, 1), (101, 0, 0, 1, 3), (101, 2, 0, 3, 2), (101, 0, 2, 2, 3)]
    rows += [(102, *b) for b in ((0, 0, 9, 1), (0, 8, 9, 9), (0, 0, 1, 9), (8, 0, 9, 9), (2, 2, 7, 3), (2, 6, 7, 7), (2, 2, 3, 7), (6, 2, 7, 7), (4, 4, 5, 5))]
    found = outline.union_polygons(frame(spark, rows), BOX, ["g"], cell=5.0).collect()
    for g in {r[0] for r in rows}:
        grid, own = cells_of([b for k, *b in rows if k == g]), [r for r in found if r.g == g]
        assert (filled([r.polygon for r in own]) == grid).all()
        for r in own:
            assert r.area == sum(map(area, r.polygon)) and area(r.polygon[0]) > 0 and all(area(h) < 0 for h in r.polygon[1:])
            for ring in r.polygon:
                points = [(p.x, p.y) for p in ring[:-1]]
                assert points[0] == min(points) and len(set(points)) == len(points) and ring[0] == ring[-1]
                turns = [(b[0] - a[0]) * (c[1] - b[1]) != (b[1] - a[1]) * (c[0] - b[0]) for a, b, c in zip(points, points[1:] + points[:1], points[2:] + points[:2], strict=True)]
                assert all(turns)  # no point within a side
        assert (len(own), sum(len(r.polygon) - 1 for r in own)) == pieces_of(grid)
        assert sorted(r.part for r in own) == list(range(len(own)))


def test_long_rings_are_chained(spark):
    """A comb whose outline has 4 000 edges."""
    comb = spark.range(1000).select(F.lit(1).alias("g"), (2 * F.col("id")).alias("x0"), F.lit(0).alias("y0"), (2 * F.col("id") + 1).alias("x1"), (2 + F.col("id") % 7).alias("y1"))
    found = outline.union_polygons(comb.union(spark.sql("SELECT 1, 0, 0, 1999, 1")), BOX, ["g"]).collect()
    assert len(found) == 1 and len(found[0].polygon) == 1 and len(found[0].polygon[0]) == 4001
    assert found[0].area == 1999 + sum(1 + k % 7 for k in range(1000))


def test_rows_without_a_box(spark):
    rows = [(1, 0, 0, 0, 5), (1, 3, 3, 2, 4), (1, None, 0, 1, 1), (None, 0, 0, 2, 2), (None, 1, 1, 3, 3)]
    df = frame(spark, rows, "").withColumn("part", F.lit("x"))
    found = outline.union_polygons(df, BOX, ["g"]).collect()
    assert [(r.g, r.area) for r in found] == [(None, 7.0)]
    assert outline.union_polygons(df.where("false"), BOX).count() == 0
    assert [r.area for r in outline.union_polygons(df, BOX).collect()] == [7.0]


@pytest.mark.parametrize("distance", [1, 2])
def test_overlays_and_buffers(spark, distance):
    rng = np.random.default_rng(distance)
    rows = [(g, *b, bool(rng.integers(0, 2))) for g, *b in random_boxes(rng, 12, 40)]
    df = frame(spark, rows, ", second boolean")

    def cells(parts):
        out = {}
        for r in parts.collect():
            own = out.setdefault(r.g, np.zeros((SIDE + 8, SIDE + 8), int))
            own[int(r.p_x0) + 4 : int(r.p_x1) + 4, int(r.p_y0) + 4 : int(r.p_y1) + 4] += 1
        assert all(o.max() == 1 for o in out.values())  # no two overlap
        return {g: o == 1 for g, o in out.items()}

    both = outline.COMMON, outline.DIFFERENCE, outline.UNION, outline.EITHER
    plain = (np.logical_and, lambda a, b: a & ~b, np.logical_or, np.logical_xor)
    for keep, same in zip(both, plain, strict=True):
        found = cells(outline.boxes_where(df, BOX, ["g"], keep, F.col("second"), cell=4.0))
        for g in range(40):
            want = np.pad(same(cells_of([r[1:5] for r in rows if r[0] == g and not r[5]]), cells_of([r[1:5] for r in rows if r[0] == g and r[5]])), 4)
            assert (found.get(g, np.zeros_like(want)) == want).all()
    union = outline.boxes_where(df, BOX, ["g"], cell=4.0)
    out, back = cells(outline.buffered(union, distance, ["g"], 4.0)), cells(outline.buffered(union, -distance, ["g"], 4.0))
    for g in range(40):
        grid = np.pad(cells_of([r[1:5] for r in rows if r[0] == g]), 4)
        near = np.pad(grid, distance)
        shifts = [near[a : a + SIDE + 8, b : b + SIDE + 8] for a in range(2 * distance + 1) for b in range(2 * distance + 1)]
        assert (out.get(g, np.zeros_like(grid)) == np.logical_or.reduce(shifts)).all()
        assert (back.get(g, np.zeros_like(grid)) == np.logical_and.reduce(shifts)).all()


def test_regions_and_their_outlines(spark):
    rng = np.random.default_rng(4)
    images = rng.integers(0, 3, (30, SIDE, SIDE)) * (rng.random((30, SIDE, SIDE)) < 0.7)
    rows = [(k, [[int(v) for v in line] for line in image]) for k, image in enumerate(images)]
    df = spark.createDataFrame([*rows, (50, None), (51, []), (52, [[], None, [None, 1, None]])], "k int, rows array<array<int>>")
    found = raster.regions(raster.runs(df, "k"), "k")
    shapes = {(r.k, r.region): r for r in raster.outlines(found, "k").collect()}
    boxes = {(r.k, r.region): r for r in raster.region_boxes(found, "k").collect()}
    assert shapes.keys() == boxes.keys() and (52, 0) in shapes
    for k, image in enumerate(images):
        numbered = sorted(r for g, r in shapes if g == k)
        assert numbered == list(range(len(numbered)))
        again = np.full(image.shape, -1)
        for n in numbered:
            shape, box = shapes[k, n], boxes[k, n]
            flipped = [[type(p)(x=p.x, y=p.y + SIDE) for p in ring] for ring in shape.polygon]
            inside = filled([flipped]).T[::-1]  # rows from the top
            assert (again[inside] == -1).all() and (image[inside] == shape.value).all() and inside.sum() == shape.area == box.area
            again[inside] = shape.value
            y, x = np.nonzero(inside)
            assert (box.x0, box.y0, box.x1, box.y1) == (x.min(), y.min(), x.max() + 1, y.max() + 1)
            assert pieces_of(inside) == (1, len(shape.polygon) - 1)
        assert (again == image).all()
    # Blocks of any size give the same regions.
    blocks = [(k, a, b, [[int(v) for v in line[b : b + 5]] for line in image[a : a + 4]]) for k, image in enumerate(images) for a in range(0, SIDE, 4) for b in range(0, SIDE, 5)]
    parts = raster.regions(raster.runs(spark.createDataFrame(blocks, "k int, top int, left int, rows array<array<int>>"), "k", top="top", left="left"), "k")
    same = {(r.k, r.region): r for r in raster.region_boxes(parts, "k").collect()}
    assert same == {k: v for k, v in boxes.items() if k[0] < 50}


def test_placed_and_simplified_outlines(spark):
    mask = spark.createDataFrame([(1, [[0, 1, 1], [0, 1, 0], [1, 0, 0]])], "k int, rows array<array<int>>")
    placed = spark.createDataFrame([(1, 100.0, 50.0, 2.0, 0.5)], "k int, x0 double, y1 double, dx double, dy double")
    found = raster.outlines(raster.regions(raster.runs(mask, "k").where("value = 1"), "k"), "k", placed).orderBy("region").collect()
    assert [[(p.x, p.y) for p in r.polygon[0]] for r in found] == [[(102.0, 49.0), (104.0, 49.0), (104.0, 49.5), (106.0, 49.5), (106.0, 50.0), (102.0, 50.0), (102.0, 49.0)], [(100.0, 48.5), (102.0, 48.5), (102.0, 49.0), (100.0, 49.0), (100.0, 48.5)]]
    assert [r.area for r in found] == [3.0, 1.0]
    fewer = raster.outlines(raster.regions(raster.runs(mask, "k").where("value = 1"), "k"), "k", placed, epsilon=1.5).orderBy("region").first()
    assert len(fewer.polygon[0]) < 7 and fewer.area == 3.0
    assert [(r.id_nodata_poly, r.area) for r in raster.nodata_polygons(mask, "k", 0, placed, least_area=2.5).collect()] == [(1, 3.0)]


def test_whole_detections_stay_apart_and_cut_ones_merge(spark):
    schema = "det_id long, d_x0 double, d_y0 double, d_x1 double, d_y1 double, det_class int, score double, year_det int"
    dets = [
        (1, 90.0, 10.0, 100.0, 20.0, 1, 0.5, 2020), (2, 100.5, 10.0, 110.0, 20.0, 2, 0.9, 2020),  # cut by the border at 100
        (3, 20.0, 20.0, 30.0, 30.0, 1, 0.5, 2020), (4, 31.0, 15.0, 40.0, 29.0, 1, 0.7, 2020),  # near, but each whole in its tile
        (5, 30.0, 30.0, 35.0, 35.0, 1, 0.1, 2020),  # touches 3 in a corner only
        (6, 100.5, 10.0, 110.0, 20.0, 2, 0.9, 2021),  # another year
    ]
    tiles = spark.createDataFrame([(0, 0, 100, 100), (100, 0, 200, 100)], "t_x0 int, t_y0 int, t_x1 int, t_y1 int")
    merged, members, within = post.merge_across_tiles(spark.createDataFrame(dets, schema), tiles, ("t_x0", "t_y0", "t_x1", "t_y1"), 1.0)
    assert [(r.component, r.year_det, r.area, r.det_class, round(r.score, 6), r.n, len(r.polygon[0])) for r in merged.orderBy("component").collect()] == [(1, 2020, 200.0, 1, 0.7, 2, 5), (6, 2021, 95.0, 2, 0.9, 1, 5)]
    assert sorted((r.component, r.det_id) for r in members.collect()) == [(1, 1), (1, 2), (6, 6)]
    assert sorted((r.component, r.area) for r in within.collect()) == [(3, 100.0), (4, 126.0), (5, 25.0)]
