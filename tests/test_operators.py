import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.functions import geometry, names, polygons
from geoloom.operators import assess, coco, graph, grids, post, raster, shapes, spatial, tilesets
from geoloom.sources import tables

DET = "det_id long, d_x0 double, d_y0 double, d_x1 double, d_y1 double, det_class int, score double, image string, year_det int, dataset string"
LABEL = "label_id long, l_x0 double, l_y0 double, l_x1 double, l_y1 double, label_class int, year_label int, dataset string"


def det(i, x, y, size=10.0, cls=0, score=0.9, image="a", year=None):
    return (i, float(x), float(y), x + size, y + size, cls, score, image, year, "val")


def label(i, x, y, size=10.0, cls=1, year=None):
    return (i, float(x), float(y), x + size, y + size, cls, year, "val")


def test_grid_join_equals_brute_force(spark):
    rng = random.Random(3)
    box = lambda: (x := rng.randint(-200, 200), y := rng.randint(-200, 200), x + rng.choice([0, 3, 40, 150]), y + rng.choice([0, 3, 40]))
    a, b = [(i, *box()) for i in range(120)], [(i, *box()) for i in range(120)]
    left, right = spark.createDataFrame(a, "i long, ax0 long, ay0 long, ax1 long, ay1 long"), spark.createDataFrame(b, "j long, bx0 long, by0 long, bx1 long, by1 long")
    found = [(r.i, r.j) for r in spatial.spatial_join(left, ("ax0", "ay0", "ax1", "ay1"), right, ("bx0", "by0", "bx1", "by1"), 50).collect()]
    want = {(p[0], q[0]) for p in a for q in b if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]}
    assert len(found) == len(set(found)) and set(found) == want


def test_join_over_levels_equals_brute_force_and_bounds_its_rows(spark):
    rng = random.Random(9)
    far = lambda: rng.choice([0, 3, 40, 150, 3000, 10**6])
    box = lambda: (x := rng.randint(-2000, 2000), y := rng.randint(-2000, 2000), x + far(), y + far())
    a, b = [(i, *box()) for i in range(150)], [(i, *box()) for i in range(150)]
    a += [(150, -(10**6), -(10**6), 10**6, 10**6), (151, None, 0, 1, 1)]
    left, right = spark.createDataFrame(a, "i long, ax0 long, ay0 long, ax1 long, ay1 long"), spark.createDataFrame(b, "j long, bx0 long, by0 long, bx1 long, by1 long")
    sides = ("ax0", "ay0", "ax1", "ay1"), ("bx0", "by0", "bx1", "by1")
    joined = spatial.spatial_join(left, sides[0], right, sides[1], 5, levels=7)
    found = [(r.i, r.j) for r in joined.collect()]
    want = {(p[0], q[0]) for p in a for q in b if p[1] is not None and p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]}
    assert len(found) == len(set(found)) and set(found) == want and set(joined.columns) == {"i", "j", *sides[0], *sides[1]}
    assert "NestedLoop" not in joined._jdf.queryExecution().executedPlan().toString()
    placed = spatial._placed(left, sides[0], 5, 7, "l", "x", "y", "o")
    assert placed.groupBy("i").count().agg(F.max("count")).first()[0] <= (spatial.RATIO + 1) ** 2 + 4 * 6
    # One box over everything and many in one cell.
    many = spark.range(100_000).select((F.col("id")).alias("j"), *((F.col("id") % 5 + k).cast("long").alias(c) for c, k in zip(sides[1], (0, 0, 2, 2), strict=True)))
    assert spatial.spatial_join(left.where("i = 150"), sides[0], many, sides[1], 5, levels=7).count() == 100_000


def test_identical_touching_and_classes(spark):
    dets = [det(0, 0, 0), det(1, 100, 0), det(2, 200, 0, cls=3), det(3, 500, 500)]
    labels = [label(0, 0, 0), label(1, 110, 0), label(2, 200, 0)]
    found = set(assess_rows(spark, dets, labels))
    assert found == {("TP", 0, 0), ("FP", 1, None), ("FN", None, 1), ("MISMATCHED CLASSES", 2, 2), ("FP", 3, None)}


def assess_rows(spark, dets, labels, **how):
    df = assess.fractional_sets(spark.createDataFrame(dets, DET), spark.createDataFrame(labels, LABEL), **how)
    return [(r.tag, r.det_id, r.label_id) for r in df.collect()]


def test_ties_go_to_the_lowest_id(spark):
    assert set(assess_rows(spark, [det(4, 0, 0), det(7, 0, 0)], [label(5, 0, 0), label(2, 0, 0)])) == {("TP", 4, 2), ("FP", 7, None), ("FN", None, 5)}


def test_empty_sides(spark):
    assert assess_rows(spark, [det(0, 0, 0)], [], area=1000) == [("FP", 0, None)]
    assert assess_rows(spark, [], [label(0, 0, 0)]) == [("FN", None, 0)]


def test_years(spark):
    dets, labels = [det(0, 0, 0, year=2020)], [label(0, 0, 0, year=2021)]
    assert assess_rows(spark, dets, labels, year="compat") == []
    assert set(assess_rows(spark, dets, labels, year="strict")) == {("FP", 0, None), ("FN", None, 0)}
    assert assess_rows(spark, dets, labels) == [("TP", 0, 0)]


def test_metrics_of_an_absent_class_and_unknown_method(spark):
    tagged = assess.fractional_sets(spark.createDataFrame([det(0, 0, 0)], DET), spark.createDataFrame([label(0, 0, 0)], LABEL))
    by_class = assess.class_counts(tagged, spark.createDataFrame([(1,), (2,)], "class int"), "dataset")
    row = assess.metrics(by_class, "dataset").first()
    assert (row.TP_k, row.FP_k, row.FN_k, row.precision, row.recall, row.f1) == (1, 0, 0, 0.5, 0.5, 0.5)
    with pytest.raises(ValueError):
        assess.metrics(by_class, "dataset", method="other")


def test_polygon_measures():
    shape = np.array([(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2)], float)
    square = np.array([(0.5, 0.5), (2.5, 0.5), (2.5, 2.5), (0.5, 2.5)])
    assert math.isclose(polygons.shared_area(shape, shape), 3.0) and math.isclose(polygons.shared_area(shape, square), 1.25)
    line = np.array([(0, 0), (1, 0.01), (2, 0), (2, 2)], float)
    assert polygons.simplify(line, 0.1).tolist() == [[0, 0], [2, 0], [2, 2]]


def test_clipped_parts_of_a_comb_equal_counting():
    rng = np.random.default_rng(3)
    teeth = [(x + d, y) for x in range(0, 12, 4) for d, y in ((0, 9), (2, 9), (2, 3), (4, 3))]
    comb = np.array([(0, 0), (0, 9), *teeth[1:], (12, 0)], float)
    solid = {(x, y) for x in range(12) for y in range(9) if y < 3 or x % 4 < 2}
    for x0, y0, w, h in rng.integers(-1, 9, (200, 4)).tolist():
        cells = {(x, y) for x, y in solid if x0 <= x < x0 + w + 1 and y0 <= y < y0 + h + 1}
        groups, left = 0, set(cells)
        while left:
            groups, todo = groups + 1, [left.pop()]
            while todo:
                x, y = todo.pop()
                near = {(x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)} & left
                left -= near
                todo += near
        for ring in (comb, comb[::-1]):
            parts = polygons.clip_box(ring, x0, y0, x0 + w + 1, y0 + h + 1)
            assert math.isclose(sum(map(polygons.abs_area, parts)), len(cells)) and len(parts) == groups, (x0, y0, w, h)


def test_clip_polygons_of_odd_rings(spark):
    ring = lambda *p: [{"x": float(x), "y": float(y)} for x, y in p]
    rows = [(1, ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))), (2, None), (3, []), (4, ring((1, 1))), (5, ring((1, 1), (3, 1), (1, 1))), (6, ring((8, 0), (12, 0), (12, 4)))]
    shapes_ = spark.createDataFrame(rows, f"id int, ring {polygons.RING}")
    tiles = spark.createDataFrame([("a", 0, 0, 8, 8), ("b", 2, 2, 3, 3), ("c", None, 0, 8, 8)], "tile string, x0 int, y0 int, x1 int, y1 int")
    box = ("x0", "y0", "x1", "y1")
    found = shapes.clip_polygons(shapes_, "ring", tiles, box, cell=4)
    assert sorted((r.id, r.tile, r.part, r.part_area) for r in found.collect()) == [(1, "a", 0, 16.0), (1, "b", 0, 1.0)]
    assert shapes.clip_polygons(shapes_.where("false"), "ring", tiles, box).count() == 0
    assert [r.tile for r in shapes.boxes_in_polygons(tiles, box, "tile", shapes_, "ring").collect()] == ["b"]
    assert sorted(r.tile for r in shapes.boxes_in_polygons(tiles, box, "tile", shapes_, "ring", how="left_anti").collect()) == ["a", "c"]
    flat = shapes_.select("id", geometry.repaired_ring(F.col("ring")).alias("r")).where("r IS NOT NULL")
    assert sorted(r.id for r in flat.collect()) == [1, 6]
    assert len(shapes_.select(polygons.simplified(0.1)("ring").alias("r")).where("r IS NOT NULL").collect()) == 5


def test_polygon_iou_column(spark):
    ring = lambda *p: [{"x": float(x), "y": float(y)} for x, y in p]
    square = ring((0, 0), (2, 0), (2, 2), (0, 2), (0, 0))
    df = spark.createDataFrame([(square, ring((1, 0), (3, 0), (3, 2), (1, 2))), (square, None)], f"a {polygons.RING}, b {polygons.RING}")
    found = [r[0] for r in df.select(polygons.polygon_iou("a", "b")).collect()]
    assert math.isclose(found[0], 1 / 3) and found[1] is None
    assert df.select(geometry.ring_area(F.col("a"))).first()[0] == 4.0


def test_names(spark):
    df = spark.createDataFrame([("(3, 4, 18)", "18_3_4.tif"), ("(2020, 3, 4, 18)", "a/2020_18_3_4.tif"), ("(x, 4, 18)", "odd.tif"), (None, None)], "id string, file string")
    rows = df.select(names.parse_tile_id(F.col("id")).alias("p"), names.file_to_id(F.col("file")).alias("f")).collect()
    assert [tuple(r.p) if r.p else None for r in rows] == [(None, 3, 4, 18), (2020, 3, 4, 18), None, None]
    assert [r.f for r in rows] == ["(3, 4, 18)", "(2020, 3, 4, 18)", None, None]


def test_geohash_of_a_known_point(spark):
    assert spark.range(1).select(geometry.geohash(F.lit(-5.6), F.lit(42.6), 5)).first()[0] == "ezs42"


def test_cover_of_one_tile(spark):
    df = spark.createDataFrame([(7.0, 46.0, 7.0001, 46.0001)], "west double, south double, east double, north double")
    assert grids.cover(df, 10).count() == 1


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(100, k) for k in range(101, 160)] + [(5, 5), (None, 3)]
    found = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert found == {**{i: 10 for i in range(10, 41)}, **{k: 100 for k in range(100, 160)}}


def test_overlap_suppression(spark):
    dets = spark.createDataFrame([det(0, 0, 0, score=0.5), det(1, 1, 0, score=0.8), det(2, 2, 0, score=0.8), det(3, 300, 0)], DET)
    assert {r.det_id for r in post.suppress_overlaps(dets).collect()} == {1, 3}
    assert {r.det_id for r in post.suppress_overlaps(dets, drop_isolated=True).collect()} == {1}


def test_merge_adjacent(spark):
    dets = spark.createDataFrame([det(0, 0, 0, cls=1, score=0.4), det(1, 12, 0, size=20.0, cls=2, score=0.8), det(2, 200, 0, cls=0)], DET)
    rows = {r.component: r for r in post.merge_adjacent(dets, 2).collect()}
    assert (rows[0].det_class, rows[0].n, rows[0].m_x1) == (2, 2, 32.0) and math.isclose(rows[0].score, 0.6) and rows[2].n == 1


def test_cluster(spark):
    dets = spark.createDataFrame([det(0, 0, 0, score=0.4), det(1, 5, 0, image="b", score=0.8), det(2, 0, 0, score=0.9)], DET).withColumn("scale", F.lit(500))
    row = post.cluster(dets).collect()
    assert [(r.component, r.n, r.scale) for r in row] == [(0, 2, 500)]


def test_exact_split_is_numpys(spark):
    tiles = spark.createDataFrame([(f"t{k:02d}",) for k in range(11)], "id string")
    found = sorted((r.id, r.dataset) for r in tilesets.split_exact(tiles, 1).collect())
    first = set(np.random.RandomState(1).choice(11, round(0.7 * 11), replace=False).tolist())
    assert {i for i, d in found if d == "trn"} == {f"t{k:02d}" for k in first} and len(found) == 11
    assert tilesets.empty_tile_count(3, 9) == 0


def test_clip_drops_touching_parts_and_rejects_overflow(spark):
    tiles = spark.createDataFrame([("t", 0.0, 0.0, 100.0, 100.0)], "id string, t_x0 double, t_y0 double, t_x1 double, t_y1 double")
    labels = spark.createDataFrame([label(0, 95, 95), label(1, 100, 0)], LABEL)
    rows = coco.annotations(coco.clip_boxes(tiles, tilesets.TILE_BOX, labels, assess.LABEL_BOX), tilesets.TILE_BOX, 256, 256).collect()
    assert [r.label_id for r in rows] == [0] and math.isclose(rows[0].area, 163.84) and math.isclose(rows[0].bbox[0], 243.2)


def test_raster(spark):
    df = spark.createDataFrame([(1, "R", [1.0, 2.0, 3.0])], "image int, band string, px array<double>")
    assert tuple(raster.band_stats(df, "image", "band", "px").first()) == (1, "R", 2.0, 0.816)
    masks = spark.createDataFrame([(1, [[1, 1, 0], [0, 0, 0], [0, 1, 1]]), (2, None)], "k int, rows array<array<int>>")
    assert [tuple(r) for r in raster.mask_boxes(masks, "k").orderBy("region").collect()] == [(1, 0, 2, 0, 0, 2, 1), (1, 1, 2, 1, 2, 3, 3)]


def test_geojson_round_trip(spark, tmp_path):
    text = '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"id":"a"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}}]}'
    (tmp_path / "x.geojson").write_text(text)
    df = tables.read_geojson(spark, str(tmp_path / "x.geojson"), "id:string")
    assert df.select("id", geometry.ring_area(F.col("ring")).alias("a")).first().a == 0.5
    assert '"coordinates":[[[0.0,0.0]' in tables.to_geojson(df).first().value


def test_categories_and_unique_ids(spark):
    labels = spark.createDataFrame([("x",)], "category string")
    assert tables.normalise_categories(labels).first().SUPERCATEGORY == "foo"
    with pytest.raises(ValueError):
        tables.normalise_categories(spark.createDataFrame([("x",)], "other string"))
    with pytest.raises(ValueError):
        tables.assert_unique(spark.createDataFrame([("x",), ("x",)], "id string"), "id")


def test_rings_are_cut_together(monkeypatch):
    rng, notch = np.random.default_rng(5), np.array([(0, 0), (1, 0), (1, 1), (0.75, 1), (0.75, 0.5), (0.25, 0.5), (0.25, 1), (0, 1)])
    rings = [notch[:: rng.choice((1, -1))] * rng.integers(8, 30, 2) + rng.integers(0, 100, 2) for _ in range(300)]
    for n in rng.integers(3, 14, 300):
        turn = np.sort(rng.random(n)) * 2 * np.pi
        rings.append(np.stack([50 + 40 * np.cos(turn), 50 + 40 * np.sin(turn)], axis=1) * rng.choice((0.1, 1), (n, 1)))
    rings += [np.zeros((0, 2)), np.ones((1, 2)), np.array([(0, 0), (50, 50), (100, 100)], float), np.array([(0, 0), (np.nan, 9), (9, 0)])]
    corner = rng.integers(-2, 10, (len(rings), 2)) * 10.0
    boxes = np.hstack([corner, corner + rng.integers(1, 6, corner.shape) * 12.5])
    boxes[7, 2] = np.nan
    count = np.array([len(r) for r in rings])
    want = [(k, p.tolist()) for k, (r, b) in enumerate(zip(rings, boxes, strict=True)) if k != 7 for p in polygons.clip_box(r, *b)]

    def found():
        points, size, row = polygons.clip_boxes(np.concatenate(rings), np.cumsum(count) - count, count, boxes)
        return [(k, p.tolist()) for k, p in zip(row.tolist(), np.split(points, np.cumsum(size)[:-1]), strict=True)]

    assert found() == want
    # One by one only where a side crosses an outline more than twice.
    single, alone = [], polygons.clip_box
    monkeypatch.setattr(polygons, "clip_box", lambda *a: single.append(a) or alone(*a))
    assert found() == want and 0 < len(single) < len(rings) / 3


def test_polygons_are_cut_only_by_boxes_in_their_bounds(spark, monkeypatch):
    rows = [(1, [{"x": x, "y": y} for x, y in ((0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0))])]
    boxes = spark.createDataFrame([("in", 0, 0, 4, 4), ("rim", 6, 6, 10, 10), ("over", 8, 8, 12, 12)], "key string, x0 int, y0 int, x1 int, y1 int")
    taken, cut = [], shapes.clip_polygons
    monkeypatch.setattr(shapes, "clip_polygons", lambda *a, **k: taken.append(cut(*a, **k)) or taken[-1])
    found = shapes.boxes_in_polygons(boxes, ("x0", "y0", "x1", "y1"), "key", spark.createDataFrame(rows, f"id int, ring {polygons.RING}"), "ring")
    assert sorted(r.key for r in found.collect()) == ["in", "rim"]
    assert sorted(r.key for r in taken[0].collect()) == ["in", "rim"]
