import json
import random

import pytest
from pyspark.sql import functions as F

from geoloom import config, jobs
from geoloom.operators import assess, coverage, enrich, grids, post
from geoloom.sources import connectors, tables

LEAST = {
    "output_folder": "out",
    "datasets": {"aoi_tiles": "t.geojson", "image_source": {"type": "XYZ", "location": "https://a/{z}/{x}/{y}.png"}, "add_fp_labels": {"fp_labels": "f.geojson"}},
}


def test_settings_take_defaults_and_name_what_is_wrong():
    found = config.load(config.Tilesets, LEAST | {"empty_tiles": {"tiles_frac": 0.25}, "other": 1})
    assert (found.fp_labels, found.fp_frac_trn, found.empty_tiles_frac, found.keep_oth_tiles, found.seed, found.source_year) == ("f.geojson", 0.7, 0.25, True, False, None)
    with pytest.raises(ValueError, match="datasets.aoi_tiles is missing"):
        config.load(config.Tilesets, {"output_folder": "out", "datasets": None})
    with pytest.raises(ValueError, match="metrics_method must be one of"):
        config.load(config.Assessment, {"datasets": {"detections": {}, "split_aoi_tiles": ""}, "metrics_method": "mean"})
    with pytest.raises(ValueError, match="score_threshold must lie"):
        config.load(config.Merging, {"detections": {}, "distance": 2, "score_threshold": 30})


def test_settings_from_a_file(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text(json.dumps({"merge": {"detections": {"trn": "a"}, "distance": 2.5, "score_threshold": 0.3}}))
    assert config.load_file(config.Merging, str(tmp_path / "c.yaml"), "merge") == config.Merging({"trn": "a"}, 2.5, 0.3)


@pytest.mark.parametrize(
    ("source", "year", "columns", "used"),
    [
        ("XYZ", "multi-year", ["year_tile"], "multi-year"), ("XYZ", "multi-year", [], ValueError), ("FOLDER", 2020, [], 2020), ("FOLDER", 2020, ["year_tile"], ValueError),
        ("XYZ", None, ["year_tile"], ValueError), ("XYZ", None, [], None), ("WMS", 2020, ["year_tile"], None), ("MIL", None, ["year_tile"], ValueError), ("FTP", None, [], ValueError),
    ],
)
def test_years_of_image_sources(source, year, columns, used):
    if used is ValueError:
        with pytest.raises(ValueError, match="year|unknown"):
            config.check_tile_year(source, year, columns)
    else:
        assert config.check_tile_year(source, year, columns) == used


def test_years_of_label_sets():
    config.check_false_years(["year"], ["year"])
    config.check_empty_years(["year"], [], 2020)
    config.check_empty_years([], [], None)
    for labels, other, year in ((["year"], [], None), ([], ["year"], None), ([], [], 2020)):
        with pytest.raises(ValueError, match="lack the year"):
            config.check_empty_years(labels, other, year)
    with pytest.raises(ValueError, match="lack the year"):
        config.check_false_years(["year"], [])


def test_ids_of_tiles_are_checked(spark):
    tiles = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id string")
    assert [tuple(r) for r in config.check_tiles(tiles("(1, 2, 3)")).collect()] == [("(1, 2, 3)", 1, 2, 3)]
    assert config.check_tiles(tiles("(2020, 1, 2, 3)").withColumn("year_tile", F.lit(2020))).first().t == 2020
    assert config.check_tiles(tiles().where("false")).count() == 0
    for bad in ("(1, 2)", "(1, 2, 3.5)", "1, 2, 3", "(2020, 1, 2, 3)"):
        with pytest.raises(Exception, match="not a tile's id"):
            config.check_tiles(tiles(bad)).collect()
    for bad in (("(1, 2, 3)", "(1, 2, 3)"), (None,)):
        with pytest.raises(ValueError, match="unique"):
            config.check_tiles(tiles(*bad))


def test_multi_polygons_come_apart(spark, tmp_path):
    square = lambda k: [[[k, 0], [k + 1, 0], [k + 1, 1], [k, 0]]]
    shapes = [{"type": "Polygon", "coordinates": square(0)}, {"type": "MultiPolygon", "coordinates": [square(5), square(7)]}, {"type": "Point", "coordinates": [1, 2]}, None]
    features = [{"type": "Feature", "properties": {"n": k}, "geometry": g} for k, g in enumerate(shapes)]
    (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    found = tables.read_geojson(spark, str(tmp_path), "n:int").collect()
    assert sorted((r.n, r.ring and r.ring[0].x) for r in found[:3]) == [(0, 0.0), (1, 5.0), (1, 7.0)]
    assert sorted((r.n, r.ring) for r in found[3:]) == [(2, None), (3, None)]


def test_labels_and_names(spark):
    assert tables.label_table(spark, None).count() == 0
    row = tables.label_table(spark, spark.createDataFrame([("a", "2020")], "category string, year string")).first()
    assert row.asDict() == {"CATEGORY": "a", "SUPERCATEGORY": "foo", "year_label": 2020}
    known, new = spark.createDataFrame([("a", "b")], "n0 string, n1 string"), spark.createDataFrame([("a", "c"), ("z", "y")], "n0 string, n2 string")
    assert [tuple(r) for r in tables.add_names(known, new, "n0", "n2").collect()] == [("a", "b", "c")]
    more = new.withColumnRenamed("n2", "n1")
    assert sorted(map(tuple, tables.add_names(known, more, "n0", "n1").collect())) == [("a", "b"), ("a", "c"), ("z", "y")]


def test_tasks_need_a_format(spark):
    tiles = spark.createDataFrame([(1, 2, 3)], "x int, y int, z int")
    row = connectors.xyz_tasks(tiles, "https://a/{year}/{z}/{x}/{y}.png", 2020).first()
    assert (row.url, row.img_file) == ("https://a/2020/3/1/2.png", "3_1_2.png")
    with pytest.raises(Exception, match="no image format"):
        connectors.xyz_tasks(tiles, "https://a/{z}/{x}/{y}").collect()


def test_uncovered_shares_count_the_own_image_only(spark):
    cells = spark.createDataFrame([(1, "a", 0.0, 0.0, 4.0, 4.0), (2, "b", 0.0, 0.0, 4.0, 4.0), (3, None, 0.0, 0.0, 4.0, 4.0)], "k int, image string, a double, b double, c double, d double")
    cover = spark.createDataFrame([("a", 0.0, 0.0, 4.0, 1.0), ("a", 0.0, 0.0, 2.0, 2.0), ("c", 0.0, 0.0, 9.0, 9.0)], "of string, e double, f double, g double, h double")
    found = coverage.uncovered(cells, ("a", "b", "c", "d"), "k", cover, ("e", "f", "g", "h"), [("image", "of")], 2)
    assert {r.k: r.share for r in found.collect()} == {1: 1 - 6 / 16, 2: 1.0, 3: 1.0}


def test_small_cells_fill_what_large_ones_leave(spark):
    """Pixels of an image of 700 by 520 are counted one by one."""
    rng = random.Random(3)
    w, h = 700, 520
    image = spark.createDataFrame([("i", 0.0, 0.0, float(w), float(h), w, h, 1.0)], "n string, a double, b double, c double, d double, w int, h int, pixel double")
    holes = [(x := rng.randrange(0, w), y := rng.randrange(0, h), x + rng.randrange(1, 400), y + rng.randrange(1, 300)) for _ in range(6)]
    nodata = spark.createDataFrame([("i", *map(float, b)) for b in holes], "n string, n_x0 double, n_y0 double, n_x1 double, n_y1 double")
    found = {(r.side, r.c_x0, r.c_y0) for r in grids.sub_tiles(image, ("a", "b", "c", "d"), "n", "w", "h", "pixel", nodata, sides=(64, 32), limits=(0.5, 0.25)).collect()}
    hole = [[False] * 832 for _ in range(832)]
    for x0, y0, x1, y1 in holes:
        for x in range(x0, min(x1, 832)):
            for y in range(y0, min(y1, 832)):
                hole[x][y] = True
    open_ = lambda x, y, s: sum(not hole[i][j] for i in range(x, x + s) for j in range(y, y + s)) / (s * s)
    want = {(64, x, y) for x in range(0, w, 64) for y in range(0, h, 64) if open_(x, y, 64) > 0.5}
    want |= {(32, x, y) for x in range(0, w, 32) for y in range(0, h, 32) if (64, x // 64 * 64, y // 64 * 64) not in want and open_(x, y, 32) > 0.25}
    assert found == want
    empty = grids.sub_tiles(image, ("a", "b", "c", "d"), "n", "w", "h", "pixel", nodata.where("false"))
    assert sorted((r.side, r.id, r.c_x1, r.c_y1) for r in empty.collect()) == [(512, "(0, 0, i)", 512.0, 512.0), (512, "(0, 512, i)", 512.0, 520.0), (512, "(512, 0, i)", 700.0, 512.0), (512, "(512, 512, i)", 700.0, 520.0)]


def test_clusters_lose_duplicates_and_number_on(spark):
    rows = [
        (0, 0.0, 0.0, 10.0, 10.0, 1, 0.9, "a", "trn"), (1, 9.0, 0.0, 20.0, 10.0, 1, 0.5, "b", "val"), (2, 0.0, 0.0, 10.0, 10.0, 1, 0.4, "a", "trn"),
        (3, 50.0, 50.0, 60.0, 60.0, 1, 0.7, "a", "trn"), (4, 9.5, 0.0, 20.0, 10.0, 2, 0.8, "c", "trn"),
    ]
    dets = spark.createDataFrame(rows, "det_id long, d_x0 double, d_y0 double, d_x1 double, d_y1 double, det_class int, score double, image string, dataset string").withColumn("scale", F.lit(500))
    found = {r.det_id: r for r in post.dissolve_clusters(dets).collect()}
    assert set(found) == {3, 4, 5} and (found[5].cluster_id, found[5].d_x1, found[5].image, found[5].dataset) == (1, 20.0, "a", None)
    assert found[5].score == pytest.approx(0.7) and found[3].cluster_id is None
    apart = {r.det_id: (r.cluster_id, r.dataset) for r in post.dissolve_clusters(dets, keep_datasets=True).collect()}
    assert apart == {0: (1, "trn"), 1: (1, "val"), 3: (None, "trn"), 4: (None, "trn")}
    assert post.dissolve_clusters(dets.where("false")).count() == 0


def test_stacked_sets_keep_their_order(spark):
    a = spark.createDataFrame([(2, 0.0, 0.0, 1.0, 2.0), (1, 0.0, 0.0, 1.0, 1.0)], "k int, a double, b double, c double, d double")
    found = enrich.stack_detections({"x": a, "y": a.withColumn("year_det", F.lit("2020")).withColumn("dataset", F.lit("?"))}, "k", ("a", "b", "c", "d")).orderBy("det_id").collect()
    assert [(r.det_id, r.dataset, r.k, r.area, r.year_det) for r in found] == [(0, "x", 1, 1.0, None), (1, "x", 2, 2.0, None), (2, "y", 1, 1.0, 2020), (3, "y", 2, 2.0, 2020)]


@pytest.mark.parametrize("area", [None, 60])
def test_an_assessment_matches_once(spark, monkeypatch, area):
    r = random.Random(4)
    box = lambda x, y: (x, y, x + r.randrange(4, 16), y + r.randrange(4, 16))
    places = [(r.randrange(190), r.randrange(90)) for _ in range(80)]
    truth = spark.createDataFrame([("ab"[k % 2], *box(*p)) for k, p in enumerate(places)], "category string, l_x0 long, l_y0 long, l_x1 long, l_y1 long")
    rows = [(k, k * 31 % 97 / 97, k % 2, 2000, ("val", "trn")[p[0] >= 100], *box(p[0] + k % 3, p[1])) for k, p in enumerate(places)]
    dets = spark.createDataFrame(rows, "det_id long, score double, det_class int, year_det int, dataset string, d_x0 long, d_y0 long, d_x1 long, d_y1 long")
    tiles = spark.createDataFrame([("l", "val", 0, 0, 100, 120), ("r", "trn", 100, 0, 220, 120)], "id string, dataset string, t_x0 long, t_y0 long, t_x1 long, t_y1 long")
    kinds = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    settings = config.load(config.Assessment, {"datasets": {"detections": {}, "split_aoi_tiles": ""}, "metrics_method": "macro-average", "area_threshold": area})
    taken, match = [], assess.best_matches
    monkeypatch.setattr(assess, "best_matches", lambda *a, **k: taken.append(1) or match(*a, **k))
    found = jobs.assess_detections(settings, dets, tiles, truth, None, kinds)
    assert len(taken) == (2 if area else 1)
    threshold = found["threshold"].first()[0]
    alone = assess.fractional_sets(dets.where(F.col("score") >= threshold), found["labels"], area=area, by_dataset=True)
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(found["tagged"]) == rows(alone) and {x.tag for x in found["tagged"].collect()} >= {"TP", "FP", "FN"}
    assert rows(found["swept"]) == rows(assess.threshold_sweep(dets, found["labels"], kinds.select(F.col("id").alias("class"))))
