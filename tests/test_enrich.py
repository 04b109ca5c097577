import random

import pytest
from pyspark.sql import functions as F

from geoloom.operators import assess, coco, coverage, enrich, tilesets
from geoloom.sources import connectors
from geoloom.storage import checkpoint_dir


def test_look_ups_keep_rows_and_name_what_is_lost(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    rows = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k int")
    assert sorted(map(tuple, enrich.look_up(rows, dim, "k").collect()), key=str) == sorted([(1, "a"), (1, "a"), (3, None), (None, None)], key=str)
    with pytest.raises(Exception, match="no partner for k"):
        enrich.look_up(rows, dim, "k", whole=True).collect()
    with pytest.raises(ValueError, match="unique"):
        enrich.look_up(rows, dim.unionByName(dim), "k")
    assert enrich.look_up(rows.where("false"), dim, "k", whole=True).count() == 0


def test_unknown_classes_are_an_error(spark):
    names = spark.createDataFrame([(1, "x"), (2, "y")], "label_class int, CATEGORY string")
    rows = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "label_class int, det_class int")
    assert sorted(((r.CATEGORY, r.det_category) for r in enrich.class_names(rows, names).collect()), key=str) == sorted([("x", "y"), (None, "x"), ("y", None)], key=str)
    with pytest.raises(Exception, match="unknown class 3"):
        enrich.class_names(spark.createDataFrame([(3, 0)], "label_class int, det_class int"), names).collect()


def test_small_rules(spark):
    row = spark.range(1).select(
        enrich.coded_category(F.lit(3.0), F.lit("n")).alias("a"), enrich.coded_category(F.lit(3.0), F.lit(None)).alias("b"), enrich.box_file(F.lit("AB12345"), ".tif").alias("c"),
        enrich.perimeter_scale(F.lit(4450.0)).alias("d"), enrich.perimeter_scale(F.lit(1e6)).alias("e"), enrich.threshold_label(F.lit(5)).alias("f"), enrich.threshold_label(F.lit(30)).alias("g"),
    ).first()
    assert tuple(row) == ("3n", "undetermined", "AB1234_5.tif", 1000, 4000, "0dot05", "0dot3")


def test_union_area_equals_counting(spark):
    rng = random.Random(5)
    boxes = [(k % 2, x := rng.randint(-40, 40), y := rng.randint(-40, 40), x + rng.choice([0, 1, 7, 30]), y + rng.choice([0, 2, 9, 30])) for k in range(80)]
    found = coverage.union_area(spark.createDataFrame(boxes, "g int, a long, b long, c long, d long"), ("a", "b", "c", "d"), ["g"], cell=16).collect()
    want = {g: len({(x, y) for h, a, b, c, d in boxes if h == g for x in range(a, c) for y in range(b, d)}) for g in (0, 1)}
    assert {r.g: r.area for r in found} == want


def test_outlines_outside_an_image_that_is_not_square_are_an_error(spark):
    tiles = spark.createDataFrame([("t", 0.0, 0.0, 10.0, 10.0)], "id string, t_x0 double, t_y0 double, t_x1 double, t_y1 double")
    inside = tiles.withColumns({"c_x0": F.lit(1.0), "c_y0": F.lit(2.0), "c_x1": F.lit(4.0), "c_y1": F.lit(10.0)})
    row = coco.annotations(inside, tilesets.TILE_BOX, 512, 256).first()
    assert row.area == pytest.approx(row.bbox[2] * row.bbox[3]) and row.bbox[1] == 0
    with pytest.raises(Exception, match="outside"):
        coco.annotations(inside.withColumn("c_y0", F.lit(-6.0)), tilesets.TILE_BOX, 512, 256).collect()


def test_positions_run_through_all_ranges(spark):
    rows = spark.createDataFrame([(g, k) for g, n in (("a", 500), ("b", 3), (None, 2)) for k in range(n)], "g string, k int").repartition(5)
    found = coco.number(rows, "g", "k").collect()
    assert sorted(((r.g, r.k + 1, r.id) for r in found), key=str) == sorted(((r.g, r.k + 1, r.k + 1) for r in found), key=str) and len(found) == 505


def test_sinks_and_files(spark, tmp_path):
    docs = spark.createDataFrame([("trn", "{}"), ("val", "[]")], "dataset string, document string")
    connectors.write_coco(docs, str(tmp_path / "coco"))
    assert sorted(map(tuple, spark.read.text(str(tmp_path / "coco")).select("dataset", "value").collect())) == [("trn", "{}"), ("val", "[]")]
    connectors.write_csv(docs, str(tmp_path / "csv"))
    assert sorted(map(tuple, spark.read.option("header", True).csv(str(tmp_path / "csv")).collect())) == [("trn", "{}"), ("val", "[]")]
    tasks, files = spark.createDataFrame([("x/a.tif",), ("b.tif",)], "img_file string"), spark.createDataFrame([("/base/a.tif",), ("/alt/a.tif",)], "path string")
    assert {r.img_file: r.path for r in connectors.folder_files(tasks, files).collect()} == {"x/a.tif": "/alt/a.tif", "b.tif": None}
    assert connectors.assert_complete(tasks, tasks.withColumn("img_file", F.regexp_replace("img_file", "tif$", "json"))) is tasks
    with pytest.raises(ValueError, match="no image"):
        connectors.assert_complete(tasks, tasks.limit(0))
    (tmp_path / "c.json").write_text('{"a_s": {"id": 1, "name": "a", "supercategory": "s"}}')
    assert [tuple(r) for r in enrich.read_categories(spark, str(tmp_path / "c.json")).collect()] == [(1, "a", "s")]


def test_labels_take_all_rows_of_a_shared_name(spark):
    cats = spark.createDataFrame([(1, "a", "s"), (2, "a", "t")], "label_class int, CATEGORY string, SUPERCATEGORY string")
    labels = spark.createDataFrame([(7, "a"), (8, "z")], "label_id int, CATEGORY string")
    assert sorted(((r.label_id, r.label_class) for r in enrich.label_classes(labels, cats).collect()), key=str) == [(7, 1), (7, 2), (8, None)]


def test_a_local_master_may_lack_a_checkpoint_folder(spark):
    assert checkpoint_dir(spark)
    assert assess.SMALL == "SMALL POLY"
