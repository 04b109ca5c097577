"""Every query of the library with its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom import config, jobs
from geoloom.functions import geometry, names, wkb
from geoloom.operators import assess, coco, coverage, enrich, grids, outline, overlay, post, raster, shapes, spatial, tilesets
from geoloom.plans import fixtures
from geoloom.plans.fixtures import SQL
from geoloom.sources import connectors, geopackage, tables, tiff
from geoloom.storage import checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
THRESHOLD = 0.3
MEET = "t_x0 <= l_x1 AND l_x0 <= t_x1 AND t_y0 <= l_y1 AND l_y0 <= t_y1"
POINTS = "SELECT CAST(event_id AS BIGINT) AS event_id, CAST(5.9 AS DOUBLE) + CAST(event_id AS BIGINT) % 4600 / CAST(1000 AS DOUBLE) AS lon, CAST(45.8 AS DOUBLE) + CAST(event_id AS BIGINT) * 17 % 2000 / CAST(1000 AS DOUBLE) AS lat FROM events"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def _with(*ctes: str) -> str:
    return "WITH " + ",".join([SQL, *ctes])


#: The tags at one threshold: each detection's best label, each label's best detection, and the rest.
MATCHED = f"""
best AS (SELECT * FROM ious WHERE score >= {THRESHOLD} QUALIFY row_number() OVER (PARTITION BY det_id ORDER BY iou DESC, label_id) = 1),
matched AS (SELECT * FROM best WHERE iou >= 0.25 QUALIFY row_number() OVER (PARTITION BY label_id ORDER BY iou DESC, det_id) = 1),
tagged AS (SELECT CASE WHEN label_class = det_class + 1 THEN 'TP' ELSE 'MISMATCHED CLASSES' END AS tag, det_id, label_id, dataset, det_class, label_class, score, round(iou, 3) AS iou FROM matched
  UNION ALL SELECT 'FP', det_id, NULL, dataset, det_class, NULL, score, NULL FROM dets WHERE score >= {THRESHOLD} AND det_id NOT IN (SELECT det_id FROM matched)
  UNION ALL SELECT 'FN', NULL, label_id, dataset, NULL, label_class, NULL, NULL FROM labels WHERE label_id NOT IN (SELECT label_id FROM matched))"""
COUNTS = """
sides AS (SELECT dataset, label_class AS class, tag = 'TP' AS tp, false AS fp, tag <> 'TP' AS fn FROM tagged WHERE label_class IS NOT NULL
  UNION ALL SELECT dataset, det_class + 1, false, tag <> 'TP', false FROM tagged WHERE det_class IS NOT NULL),
counts AS (SELECT dataset, c.class, count(*) FILTER (tp) AS TP_k, count(*) FILTER (fp) AS FP_k, count(*) FILTER (fn) AS FN_k
  FROM sides s, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS class) c WHERE s.class = c.class GROUP BY dataset, c.class),
by_class AS (SELECT *, CASE WHEN TP_k > 0 THEN TP_k / CAST(TP_k + FP_k AS DOUBLE) ELSE 0 END AS precision_k, CASE WHEN TP_k > 0 THEN TP_k / CAST(TP_k + FN_k AS DOUBLE) ELSE 0 END AS recall_k FROM counts)"""


def _score(precision: str, recall: str, keys: str = "dataset", source: str = "by_class") -> str:
    return f"""
sums AS (SELECT {keys}, CAST(sum(TP_k) AS BIGINT) AS TP_k, CAST(sum(FP_k) AS BIGINT) AS FP_k, CAST(sum(FN_k) AS BIGINT) AS FN_k, {precision} AS precision, {recall} AS recall FROM {source} GROUP BY {keys}),
scored AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM sums)"""


def _folded(x: str) -> str:
    return f"list_reduce(list({x} ORDER BY class), lambda a, b: a + b, CAST(0 AS DOUBLE))"


MACRO = (f"{_folded('precision_k')} / count(*)", f"{_folded('recall_k')} / count(*)")
WEIGHTED = tuple(f"{_folded(f'CAST(TP_k + FN_k AS DOUBLE) * {c}')} / CAST(sum(TP_k + FN_k) AS DOUBLE) / count(*)" for c in ("precision_k", "recall_k"))
MICRO = tuple(f"CASE WHEN sum(TP_k) > 0 THEN CAST(sum(TP_k) AS DOUBLE) / CAST(sum(TP_k) + sum({c}) AS DOUBLE) ELSE 0 END" for c in ("FP_k", "FN_k"))


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess.fractional_sets(fixtures.detections(spark, sf_dir).where(F.col("score") >= THRESHOLD), fixtures.labels(spark, sf_dir))


def _by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess.class_counts(_tagged(spark, sf_dir), fixtures.classes(spark), "dataset")


@query(_with() + " SELECT det_id, label_id, iou FROM ious")
def iou_pairs(spark, sf_dir):
    return assess.iou_pairs(fixtures.detections(spark, sf_dir), fixtures.labels(spark, sf_dir)).select("det_id", "label_id", "iou")


@query(_with(MATCHED) + " SELECT * FROM tagged")
def fractional_sets(spark, sf_dir):
    return _tagged(spark, sf_dir)


@query(_with(MATCHED) + " SELECT tag, count(*) AS n FROM tagged GROUP BY tag")
def fractional_counts(spark, sf_dir):
    return _tagged(spark, sf_dir).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


@query(_with(MATCHED, COUNTS) + " SELECT dataset, class, TP_k, FP_k, FN_k, precision_k, recall_k FROM by_class")
def metrics_by_class(spark, sf_dir):
    return _by_class(spark, sf_dir)


@query(_with(MATCHED, COUNTS, _score(*MACRO)) + " SELECT * FROM scored")
def global_metrics(spark, sf_dir):
    return assess.metrics(_by_class(spark, sf_dir), "dataset")


@query(_with(MATCHED, COUNTS, _score(*WEIGHTED)) + " SELECT * FROM scored")
def metrics_weighted(spark, sf_dir):
    return assess.metrics(_by_class(spark, sf_dir), "dataset", method="macro-weighted-average")


@query(_with(MATCHED, COUNTS, _score(*MICRO)) + " SELECT * FROM scored")
def metrics_micro(spark, sf_dir):
    return assess.metrics(_by_class(spark, sf_dir), "dataset", method="micro-average")


SWEPT = """
steps AS (SELECT CAST(unnest(range(5, 100, 5)) AS INTEGER) AS threshold),
chosen AS (SELECT * FROM ious WHERE dataset = l_dataset QUALIFY row_number() OVER (PARTITION BY det_id ORDER BY iou DESC, label_id) = 1),
won AS (SELECT c.*, threshold FROM chosen c JOIN steps ON score >= threshold / CAST(100 AS DOUBLE) WHERE iou >= 0.25 QUALIFY row_number() OVER (PARTITION BY threshold, label_id ORDER BY iou DESC, det_id) = 1),
hits AS (SELECT dataset, threshold, label_class AS class, count(*) AS n FROM won WHERE label_class = det_class + 1 GROUP BY ALL),
shown AS (SELECT dataset, threshold, det_class + 1 AS class, count(*) AS n FROM dets JOIN steps ON score >= threshold / CAST(100 AS DOUBLE) GROUP BY ALL),
there AS (SELECT dataset, threshold, label_class AS class, count(*) AS n FROM labels, steps GROUP BY ALL),
counts AS (SELECT t.dataset, t.threshold, t.class, coalesce(h.n, 0) AS TP_k, coalesce(s.n, 0) - coalesce(h.n, 0) AS FP_k, t.n - coalesce(h.n, 0) AS FN_k
  FROM there t LEFT JOIN hits h USING (dataset, threshold, class) LEFT JOIN shown s USING (dataset, threshold, class)),
by_class AS (SELECT *, CASE WHEN TP_k > 0 THEN TP_k / CAST(TP_k + FP_k AS DOUBLE) ELSE 0 END AS precision_k, CASE WHEN TP_k > 0 THEN TP_k / CAST(TP_k + FN_k AS DOUBLE) ELSE 0 END AS recall_k FROM counts)"""


def _swept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess.threshold_sweep(fixtures.detections(spark, sf_dir), fixtures.labels(spark, sf_dir), fixtures.classes(spark))


@query(_with(SWEPT) + " SELECT dataset, threshold, class, TP_k, FP_k, FN_k, precision_k, recall_k FROM by_class")
def threshold_sweep(spark, sf_dir):
    return _swept(spark, sf_dir)


@query(_with(SWEPT, _score(*MACRO, keys="dataset, threshold")) + " SELECT threshold, f1 FROM scored WHERE dataset = 'val' ORDER BY f1 DESC, threshold LIMIT 1")
def best_threshold(spark, sf_dir):
    return assess.best_threshold(_swept(spark, sf_dir))


@query(_with(MATCHED) + " SELECT dataset, label_class, det_class + 1 AS det_class, count(*) AS n FROM tagged GROUP BY ALL")
def confusion_matrix(spark, sf_dir):
    return assess.confusion_matrix(_tagged(spark, sf_dir))


def _categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tilesets.category_ids(fixtures.labels(spark, sf_dir).withColumn("supercategory", F.lit("foo")))
    return found.select(F.col("id").alias("label_class"), F.col("name").alias("CATEGORY"), F.col("supercategory").alias("SUPERCATEGORY"))


NAMES = "cats AS (SELECT CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS c, name FROM (SELECT DISTINCT o_orderpriority AS name FROM orders))"


@query(_with(MATCHED, NAMES) + " SELECT tag, det_id, label_id, a.name AS CATEGORY, b.name AS det_category FROM tagged LEFT JOIN cats a ON a.c = label_class LEFT JOIN cats b ON b.c = det_class + 1")
def class_names(spark, sf_dir):
    return enrich.class_names(_tagged(spark, sf_dir), _categories(spark, sf_dir)).select("tag", "det_id", "label_id", "CATEGORY", "det_category")


@query(_with(NAMES) + " SELECT label_id, name AS CATEGORY, c AS label_class FROM labels JOIN cats ON category = name")
def label_classes(spark, sf_dir):
    labels = fixtures.labels(spark, sf_dir).select("label_id", F.col("category").alias("CATEGORY"))
    return enrich.label_classes(labels, _categories(spark, sf_dir)).select("label_id", "CATEGORY", "label_class")


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
FOUND = ", ".join(f"""count(*) FILTER (det_name = '{n}') AS "{n}" """ for n in PRIORITIES)


@query(_with(MATCHED, NAMES) + f" SELECT dataset, true_class, {FOUND}, count(*) FILTER (det_name IS NULL) AS \"missed labels\" FROM (SELECT dataset, coalesce(a.name, 'background') AS true_class, b.name AS det_name FROM tagged LEFT JOIN cats a ON a.c = label_class LEFT JOIN cats b ON b.c = det_class + 1) GROUP BY dataset, true_class")
def confusion_table(spark, sf_dir):
    return enrich.confusion_table(enrich.class_names(_tagged(spark, sf_dir), _categories(spark, sf_dir)), PRIORITIES)


@query(_with(MATCHED) + " SELECT tag, det_id, label_id FROM tagged WHERE tag <> 'FN'")
def drop_missed(spark, sf_dir):
    return enrich.drop_missed(_tagged(spark, sf_dir)).select("tag", "det_id", "label_id")


@query("SELECT l_orderkey, l_linenumber, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def whole_look_up(spark, sf_dir):
    """Lines with their order's priority; a line without an order would be an error."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_orderkey").alias("key"), "l_linenumber")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("key"), "o_orderpriority")
    return enrich.look_up(lines, orders, "key", whole=True).withColumnRenamed("key", "l_orderkey")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IS NOT NULL AND lang IS NOT NULL")
def drop_incomplete(spark, sf_dir):
    return enrich.drop_incomplete(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"))


@query(_with() + """ SELECT label_id, CASE WHEN label_class < 3 THEN label_class || category ELSE 'undetermined' END AS code, substr(name, 1, 6) || '_' || substr(name, 7) || '.tif' AS file,
CASE WHEN perimeter <= 2575 THEN 500 WHEN perimeter <= 4450 THEN 1000 WHEN perimeter <= 9680 THEN 2000 ELSE 4000 END AS scale,
CASE WHEN t % 10 = 0 THEN '0dot' || t // 10 ELSE '0dot' || lpad(CAST(t AS VARCHAR), 2, '0') END AS threshold
FROM (SELECT *, 'Z' || (label_id + 1000000) AS name, 2 * (w + h) * 60 AS perimeter, label_id % 99 + 1 AS t FROM labels)""")
def label_codes(spark, sf_dir):
    labels = fixtures.labels(spark, sf_dir)
    color, name = F.when(F.col("label_class") < 3, F.col("category")).otherwise(""), F.concat(F.lit("Z"), F.col("label_id") + 1000000)
    return labels.select(
        "label_id", enrich.coded_category(F.col("label_class").cast("double"), color).alias("code"), enrich.box_file(name, ".tif").alias("file"),
        enrich.perimeter_scale((F.col("w") + F.col("h")) * 120).alias("scale"), enrich.threshold_label(F.col("label_id") % 99 + 1).alias("threshold"),
    )


@query(_with() + " SELECT dataset, CAST(count(*) AS DOUBLE) AS area FROM (SELECT DISTINCT dataset, x, y FROM (SELECT dataset, x, unnest(range(l_y0, l_y1)) AS y FROM (SELECT dataset, unnest(range(l_x0, l_x1)) AS x, l_y0, l_y1 FROM labels))) GROUP BY dataset")
def covered_area(spark, sf_dir):
    return coverage.union_area(fixtures.labels(spark, sf_dir), assess.LABEL_BOX, ["dataset"])


@query(_with() + """, unit AS (SELECT DISTINCT x, y FROM (SELECT x, unnest(range(l_y0, l_y1)) AS y FROM (SELECT unnest(range(l_x0, l_x1)) AS x, l_y0, l_y1 FROM labels))),
shares AS (SELECT id, 1 - count(x) / CAST(10000 AS DOUBLE) AS share FROM tiles LEFT JOIN unit ON x // 100 = tx AND y // 100 = ty GROUP BY id)
SELECT id, round(share, 6) AS share FROM shares WHERE share > 0.5""")
def coverage_test(spark, sf_dir):
    shares = coverage.uncovered(fixtures.tiles(spark, sf_dir), tilesets.TILE_BOX, "id", fixtures.labels(spark, sf_dir), assess.LABEL_BOX)
    return coverage.coverage_test(shares, 0.5).withColumn("share", F.round("share", 6))


INSIDE = "l_x0 >= t_x0 AND l_y0 >= t_y0 AND l_x1 <= t_x1 AND l_y1 <= t_y1"


@query(_with() + f" SELECT label_id, EXISTS (SELECT 1 FROM tiles WHERE {INSIDE}) AS inside FROM labels")
def contained_labels(spark, sf_dir):
    labels, tiles = fixtures.labels(spark, sf_dir), fixtures.tiles(spark, sf_dir)
    part = lambda how, yes: spatial.contained(labels, assess.LABEL_BOX, tiles, tilesets.TILE_BOX, "label_id", 128, how).select("label_id", F.lit(yes).alias("inside"))
    return part("left_semi", True).unionByName(part("left_anti", False))


@query(_with() + " SELECT label_id, (l_x0 + l_x1) / CAST(2 AS DOUBLE) AS x, (l_y0 + l_y1) / CAST(2 AS DOUBLE) AS y, CAST(w * h AS DOUBLE) AS area FROM labels")
def ring_centroid(spark, sf_dir):
    labels = fixtures.labels(spark, sf_dir).withColumn("ring", geometry.box_ring(assess.LABEL_BOX)).withColumn("c", geometry.ring_centroid(F.col("ring")))
    return labels.select("label_id", F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"), geometry.ring_area(F.col("ring")).alias("area"))


def _notched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as rings that are open at the top: the upper half of the middle half is missing."""
    x0, y0, w, h = (F.col(c).cast("double") for c in ("l_x0", "l_y0", "w", "h"))
    corners = ((0, 0), (1, 0), (1, 1), (0.75, 1), (0.75, 0.5), (0.25, 0.5), (0.25, 1), (0, 1), (0, 0))
    ring = F.array(*(F.struct((x0 + w * a).alias("x"), (y0 + h * b).alias("y")) for a, b in corners))
    return fixtures.labels(spark, sf_dir).select("label_id", ring.alias("ring"))


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


NOTCHED = _with() + " SELECT label_id, CAST(w * h AS DOUBLE) * 0.75 AS area, CAST(l_x0 AS DOUBLE) AS x, CAST(8 AS BIGINT) AS corners FROM labels"


def _measured(found: DataFrame) -> DataFrame:
    ring = F.col("geom")[0][0]
    return found.select("label_id", F.round(geometry.ring_area(ring), 6).cast("double").alias("area"), F.array_min(F.transform(ring, lambda p: p["x"])).alias("x"), (F.size(ring) - 1).cast("long").alias("corners"))


@query(NOTCHED)
def geopackage_scan(spark, sf_dir):
    """Notched labels written as GeoPackage files, one a task, and read back in ranges of rows."""
    geopackage.register(spark)
    path = _folder(spark, "geopackage")
    _notched(spark, sf_dir).select("label_id", F.array(F.array("ring")).alias("geom")).write.format("geopackage").mode("append").option("srs", 2056).save(path)
    return _measured(spark.read.format("geopackage").option("rows", 4096).load(path))


@query(NOTCHED)
def wkb_scan(spark, sf_dir):
    """Notched labels as Parquet with well-known binary."""
    path = _folder(spark, "wkb")
    _notched(spark, sf_dir).select("label_id", wkb.to_wkb(F.array(F.array("ring"))).alias("geom")).write.parquet(path)
    return _measured(spark.read.parquet(path).withColumn("geom", wkb.from_wkb("geom")))


def _common(x0: str, y0: str, x1: str, y1: str) -> str:
    sides = [f"l_x0 + w * {x0}", f"l_y0 + h * {y0}", f"l_x0 + w * {x1}", f"l_y0 + h * {y1}"]
    return f"greatest(least(t_x1, {sides[2]}) - greatest(t_x0, {sides[0]}), 0) * greatest(least(t_y1, {sides[3]}) - greatest(t_y0, {sides[1]}), 0)"


NOTCHED = f"""
cut AS (SELECT id, label_id, {_common('0', '0', '1', '0.5')} AS base, {_common('0', '0.5', '0.25', '1')} AS west, {_common('0.75', '0.5', '1', '1')} AS east FROM tiles JOIN labels ON {MEET})"""


@query(_with(NOTCHED) + " SELECT id, label_id, CAST(CASE WHEN base > 0 THEN 1 ELSE CAST(west > 0 AS INTEGER) + CAST(east > 0 AS INTEGER) END AS BIGINT) AS parts, round(CAST(base + west + east AS DOUBLE), 6) AS area FROM cut WHERE base + west + east > 0")
def clip_polygons(spark, sf_dir):
    parts = shapes.clip_polygons(_notched(spark, sf_dir), "ring", fixtures.tiles(spark, sf_dir), tilesets.TILE_BOX)
    return parts.groupBy("id", "label_id").agg(F.count(F.lit(1)).alias("parts"), F.round(F.sum("part_area"), 6).alias("area"))


@query(_with(NOTCHED.replace("FROM tiles JOIN labels", "FROM (SELECT key AS id, t_x0 // 10 AS t_x0, t_y0 // 10 AS t_y0, t_x0 // 10 + 4 AS t_x1, t_y0 // 10 + 2 AS t_y1 FROM tiles) JOIN labels")) + " SELECT key FROM tiles WHERE key NOT IN (SELECT id FROM cut WHERE base + west + east >= 7.9999)")
def tiles_off_polygons(spark, sf_dir):
    """Boxes of 4 by 2, spread over the labels, that lie whole in no notched label."""
    box = {"t_x0": F.floor(F.col("t_x0") / 10), "t_y0": F.floor(F.col("t_y0") / 10)}
    small = fixtures.tiles(spark, sf_dir).select("key", *(c.alias(n) for n, c in box.items()))
    small = small.withColumn("t_x1", F.col("t_x0") + 4).withColumn("t_y1", F.col("t_y0") + 2)
    return shapes.boxes_in_polygons(small, tilesets.TILE_BOX, "key", _notched(spark, sf_dir), "ring", how="left_anti").select("key")


def _notch_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each notched label and each detection that meets its bounds, as polygons notch and own, with det_id and label_id."""
    notched = _notched(spark, sf_dir).select("label_id", F.array("ring").alias("notch"))
    labels = fixtures.labels(spark, sf_dir).select("label_id", *assess.LABEL_BOX).join(notched, "label_id")
    dets = fixtures.detections(spark, sf_dir).select("det_id", *assess.DET_BOX)
    pairs = spatial.spatial_join(dets, assess.DET_BOX, labels, assess.LABEL_BOX)
    return pairs.select("det_id", "label_id", "notch", F.array(geometry.box_ring(assess.DET_BOX)).alias("own"))


#: Areas of the lower half and the two upper quarters of a notched label in a detection.
NOTCH_PAIRS = "cut AS (SELECT det_id, label_id, (d_x1 - d_x0) * (d_y1 - d_y0) AS own, (l_x1 - l_x0) * (l_y1 - l_y0) * CAST(0.75 AS DOUBLE) AS notched, " + ", ".join(
    f"greatest(least(d_x1, l_x0 + (l_x1 - l_x0) * {c}) - greatest(d_x0, l_x0 + (l_x1 - l_x0) * {a}), 0) * greatest(least(d_y1, l_y0 + (l_y1 - l_y0) * {d}) - greatest(d_y0, l_y0 + (l_y1 - l_y0) * {b}), 0) AS {n}"
    for n, a, b, c, d in (("base", "0", "0", "1", "0.5"), ("west", "0", "0.5", "0.25", "1"), ("east", "0.75", "0.5", "1", "1"))
) + " FROM pairs)"


@query(_with(NOTCH_PAIRS) + """ SELECT det_id, label_id, round(CAST(base + west + east AS DOUBLE), 6) AS common, round(CAST(notched - base - west - east AS DOUBLE), 6) AS label_only,
CAST(CASE WHEN base > 0 THEN 1 ELSE CAST(west > 0 AS INTEGER) + CAST(east > 0 AS INTEGER) END AS BIGINT) AS parts FROM cut WHERE base + west + east > 0""")
def polygon_overlay(spark, sf_dir):
    """Intersections of notched labels and detections with their parts, and what is left of the labels."""
    found = overlay.pair_measures(_notch_pairs(spark, sf_dir), "notch", "own", {"common": outline.COMMON, "rest": outline.DIFFERENCE}).where("common.area > 0")
    return found.select("det_id", "label_id", F.round("common.area", 6).alias("common"), F.round("rest.area", 6).alias("label_only"), "common.parts")


@query(_with() + " SELECT label_id, w * h / CAST(2 AS DOUBLE) AS area, CAST(2 AS BIGINT) AS parts FROM labels")
def crossed_rings(spark, sf_dir):
    """Labels as bow ties, whose rings cross in the middle: two triangles that touch."""
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in assess.LABEL_BOX)
    ring = F.array(*(F.struct(x.alias("x"), y.alias("y")) for x, y in ((x0, y0), (x1, y1), (x1, y0), (x0, y1))))
    ties = fixtures.labels(spark, sf_dir).select("label_id", F.array(ring).alias("polygon"))
    found = overlay.parts(overlay.overlay(ties, "polygon", ["label_id"]), ["label_id"])
    return found.groupBy("label_id").agg(F.round(F.sum("area"), 6).alias("area"), F.count(F.lit(1)).alias("parts"))


#: A corner of four quarters of 16 pieces each, of radius 3.
@query(_with() + """ SELECT label_id, round(w * h + 6 * (w + h) + 9 * 32 * sin(pi() / 32), 3) AS grown, CAST(greatest(w - 10, 0) * greatest(h - 10, 0) AS DOUBLE) AS shrunk FROM labels""")
def round_buffers(spark, sf_dir):
    """Areas of labels grown by 3 with round corners, and of what lies at least 5 inside."""
    boxes = fixtures.labels(spark, sf_dir).select("label_id", F.array(geometry.box_ring(assess.LABEL_BOX)).alias("polygon"))
    area = lambda d, name: overlay.areas(overlay.round_buffer(boxes, "polygon", d, ["label_id"]), ["label_id"]).select("label_id", F.round("area", 3).alias(name))
    return area(3.0, "grown").join(area(-5.0, "shrunk"), "label_id", "left").withColumn("shrunk", F.coalesce("shrunk", F.lit(0.0)))


@query(f"""WITH s AS (SELECT event_id, lon, lat, (lon * 3600 - 26782.5) / 10000 AS a, (lat * 3600 - 169028.66) / 10000 AS b FROM ({POINTS}))
SELECT event_id, round(2600072.37 + 211455.93 * a - 10938.51 * a * b - 0.36 * a * b ** 2 - 44.54 * a ** 3, 2) AS east,
  round(1200147.07 + 308807.95 * b + 3745.25 * a ** 2 + 76.63 * b ** 2 - 194.56 * a ** 2 * b + 119.79 * b ** 3, 2) AS north, true AS returns FROM s""")
def swiss_grid(spark, sf_dir):
    """To the Swiss grid, and whether the way back ends within the formulas' stated error (0.18 seconds)."""
    east, north = geometry.to_swiss(F.col("lon"), F.col("lat"))
    there = fixtures.points(spark, sf_dir).select("event_id", "lon", "lat", east.alias("east"), north.alias("north"))
    lon, lat = geometry.from_swiss(F.col("east"), F.col("north"))
    returns = (F.abs(lon - F.col("lon")) < 5e-5) & (F.abs(lat - F.col("lat")) < 5e-5)
    return there.select("event_id", F.round("east", 2).alias("east"), F.round("north", 2).alias("north"), returns.alias("returns"))


@query(_with() + " SELECT label_id, CAST([l_x0, l_y0, l_x1, l_y0, l_x1, l_y1, l_x0, l_y1, l_x0, l_y0] AS VARCHAR) AS ring FROM labels")
def repair_rings(spark, sf_dir):
    """Rings against the clock and closed again that were reversed, opened and given each point twice."""
    box = fixtures.labels(spark, sf_dir).select("label_id", F.reverse(geometry.box_ring(assess.LABEL_BOX)).alias("ring"))
    broken = box.select("label_id", F.flatten(F.transform(F.slice("ring", 1, 4), lambda p: F.array(p, p))).alias("ring"))
    flat = F.transform(geometry.flatten_ring(geometry.repaired_ring(F.col("ring"))), lambda v: v.cast("long").cast("string"))
    return broken.select("label_id", F.concat(F.lit("["), F.array_join(flat, ", "), F.lit("]")).alias("ring"))


@query(f"SELECT event_id, round(radians(lon) * 6378137, 3) AS x, round(ln(tan(pi() / 4 + radians(lat) / 2)) * 6378137, 3) AS y, round(lon, 6) AS lon, round(lat, 6) AS lat FROM ({POINTS})")
def reproject(spark, sf_dir):
    """To Web Mercator and back."""
    x, y = geometry.to_mercator(F.col("lon"), F.col("lat"))
    there = fixtures.points(spark, sf_dir).select("event_id", x.alias("x"), y.alias("y"))
    lon, lat = geometry.from_mercator(F.col("x"), F.col("y"))
    return there.select("event_id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@query(_with() + " SELECT key, t_x0 || '.0,' || t_y0 || '.0,' || t_x1 || '.0,' || t_y1 || '.0' AS bbox, '256' AS width, '256,256' AS size FROM tiles")
def service_requests(spark, sf_dir):
    wms = connectors.wms_request(tilesets.TILE_BOX, "ortho", "EPSG:3857", 256, 256)
    export = connectors.export_request(tilesets.TILE_BOX, 3857, 256, 256)
    return fixtures.tiles(spark, sf_dir).select("key", wms["BBOX"].alias("bbox"), wms["WIDTH"].alias("width"), export["size"].alias("size"))


YEARLY = f"""
near AS (SELECT * FROM ious WHERE score >= {THRESHOLD}), agreed AS (SELECT * FROM near WHERE year_det = year_label),
best AS (SELECT * FROM agreed QUALIFY row_number() OVER (PARTITION BY det_id ORDER BY iou DESC, label_id) = 1),
matched AS (SELECT * FROM best WHERE iou >= 0.25 QUALIFY row_number() OVER (PARTITION BY label_id, year_det ORDER BY iou DESC, det_id) = 1),
hits AS (SELECT CASE WHEN label_class = det_class + 1 THEN 'TP' ELSE 'MISMATCHED CLASSES' END AS tag, count(*) AS n FROM matched GROUP BY tag)"""


def _year_sql(lost: bool) -> str:
    fp = " AND (det_id NOT IN (SELECT det_id FROM near) OR det_id IN (SELECT det_id FROM agreed))" if lost else ""
    fn = " AND (label_id NOT IN (SELECT label_id FROM near) OR label_id IN (SELECT label_id FROM agreed))" if lost else ""
    return _with(YEARLY) + f""" SELECT * FROM hits UNION ALL SELECT 'FP', count(*) FROM dets WHERE score >= {THRESHOLD} AND det_id NOT IN (SELECT det_id FROM matched){fp}
UNION ALL SELECT 'FN', count(*) FROM labels WHERE label_id NOT IN (SELECT label_id FROM matched){fn}"""


def _year_counts(spark: SparkSession, sf_dir: str, year: str) -> DataFrame:
    dets = fixtures.detections(spark, sf_dir).where(F.col("score") >= THRESHOLD)
    return assess.fractional_sets(dets, fixtures.labels(spark, sf_dir), year=year).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


@query(_year_sql(False))
def year_strict_sets(spark, sf_dir):
    return _year_counts(spark, sf_dir, "strict")


@query(_year_sql(True))
def year_compat_sets(spark, sf_dir):
    return _year_counts(spark, sf_dir, "compat")


@query(_with() + " SELECT 'det' AS side, count(*) AS n FROM dets WHERE (d_x1 - d_x0) * (d_y1 - d_y0) < 200 UNION ALL SELECT 'label', count(*) FROM labels WHERE (l_x1 - l_x0) * (l_y1 - l_y0) < 200")
def area_split(spark, sf_dir):
    small = assess.fractional_sets(fixtures.detections(spark, sf_dir), fixtures.labels(spark, sf_dir), area=200).where(F.col("tag") == assess.SMALL)
    return small.groupBy(F.when(F.col("det_id").isNull(), "label").otherwise("det").alias("side")).agg(F.count(F.lit(1)).alias("n"))


@query(_with() + " SELECT det_id, score FROM dets WHERE score > 0.5 AND (d_x1 - d_x0) * (d_y1 - d_y0) > 300")
def score_area_filter(spark, sf_dir):
    return post.filter_detections(fixtures.detections(spark, sf_dir), 0.5, 300).select("det_id", "score")


@query(_with() + " SELECT det_id, det_class FROM dets WHERE det_class NOT IN (1, 2) OR (det_class = 1 AND (d_x1 - d_x0) * (d_y1 - d_y0) BETWEEN 100 AND 400) OR (det_class = 2 AND (d_x1 - d_x0) * (d_y1 - d_y0) BETWEEN 200 AND 600)")
def scale_area_filter(spark, sf_dir):
    ranges = spark.createDataFrame([(1, 100, 400), (2, 200, 600)], "scale int, low long, high long")
    dets = fixtures.detections(spark, sf_dir).withColumn("scale", F.col("det_class"))
    return post.filter_scale_area(dets, ranges).select("det_id", "det_class")


@query(_with() + " SELECT det_id, (gr * 31 + gc * 17) % 2000 AS elevation FROM (SELECT det_id, CAST(floor(((d_x0 + d_x1) / 2.0 + 10) / 10.0) AS BIGINT) AS gc, CAST(floor((5100 - (d_y0 + d_y1) / 2.0) / 10.0) AS BIGINT) AS gr FROM dets) WHERE (gr * 31 + gc * 17) % 2000 BETWEEN 1 AND 1199 AND gr BETWEEN 0 AND 511 AND gc BETWEEN 0 AND 511")
def elevation_filter(spark, sf_dir):
    cells = spark.range(512 * 512).select(F.expr("id div 512").alias("row"), (F.col("id") % 512).alias("col"))
    cells = cells.withColumn("elevation", (F.col("row") * 31 + F.col("col") * 17) % 2000)
    return post.filter_elevation(fixtures.detections(spark, sf_dir), cells, -10.0, 5100.0, 10.0, 1200).select("det_id", "elevation")




@query(_with() + f" SELECT id FROM tiles WHERE EXISTS (SELECT 1 FROM labels WHERE {MEET})")
def tile_semi(spark, sf_dir):
    return spatial.spatial_semi_join(fixtures.tiles(spark, sf_dir), tilesets.TILE_BOX, fixtures.labels(spark, sf_dir), assess.LABEL_BOX, "id", 128).select("id")


#: Few labels, so that many tiles meet none.
FEW = "label_class = 1 AND label_id % 7 = 0"


@query(_with() + f" SELECT id FROM tiles WHERE NOT EXISTS (SELECT 1 FROM labels WHERE {FEW} AND {MEET})")
def empty_tile_candidates(spark, sf_dir):
    return spatial.spatial_semi_join(fixtures.tiles(spark, sf_dir), tilesets.TILE_BOX, fixtures.labels(spark, sf_dir).where(FEW), assess.LABEL_BOX, "id", 128, "left_anti").select("id")


@query(_with() + f" SELECT id, category, count(*) AS n FROM tiles JOIN labels ON {MEET} GROUP BY id, category")
def labels_per_tile(spark, sf_dir):
    return tilesets.labels_per_tile(fixtures.tiles(spark, sf_dir), fixtures.labels(spark, sf_dir), assess.LABEL_BOX, "category")


def _kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles, labels = fixtures.tiles(spark, sf_dir), fixtures.labels(spark, sf_dir)
    ids = lambda rule: tilesets.met_ids(tiles, labels.where(rule), assess.LABEL_BOX)
    return tilesets.tile_kinds(tiles, ids("label_class <= 3"), ids("label_class = 4 AND label_id % 5 = 0"), ids("label_class = 5"))


KIND = f"""
kinds AS (SELECT tiles.*, CASE WHEN gt AND NOT oth THEN 'gt' WHEN fp AND NOT gt THEN 'fp' WHEN oth THEN 'oth' ELSE 'empty' END AS tile_kind FROM
  (SELECT id, bool_or(label_class <= 3) IS TRUE AS gt, bool_or(label_class = 4 AND label_id % 5 = 0) IS TRUE AS oth, bool_or(label_class = 5) IS TRUE AS fp FROM tiles LEFT JOIN labels ON {MEET} GROUP BY id) JOIN tiles USING (id))"""


@query(_with(KIND) + " SELECT id, tile_kind FROM kinds")
def tile_kind(spark, sf_dir):
    return _kinds(spark, sf_dir).select("id", "tile_kind")


PLACE = "(key * 7919 + 104729) % 1000003"
SPLIT = f"CASE WHEN {PLACE} % 1000 < 700 THEN 'trn' WHEN {PLACE} % 1000 < 850 THEN 'val' ELSE 'tst' END"


@query(_with() + f" SELECT id, {SPLIT} AS dataset FROM tiles")
def split_hash(spark, sf_dir):
    return tilesets.split(fixtures.tiles(spark, sf_dir)).select("id", "dataset")


EMPTY = KIND.replace("label_class <= 3", f"({FEW})")


def _few_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles, labels = fixtures.tiles(spark, sf_dir), fixtures.labels(spark, sf_dir)
    ids = lambda rule: tilesets.met_ids(tiles, labels.where(rule), assess.LABEL_BOX)
    return tilesets.tile_kinds(tiles, ids(FEW), ids("label_class = 4 AND label_id % 5 = 0"), ids("label_class = 5 AND label_id % 11 = 0"))


EMPTY = EMPTY.replace("label_class = 5", "label_class = 5 AND label_id % 11 = 0")


@query(_with(EMPTY) + f""", n AS (SELECT greatest(0, CAST(trunc(0.5 * (count(*) FILTER (tile_kind = 'gt') - count(*) FILTER (tile_kind = 'fp'))) AS BIGINT)) AS n FROM kinds)
SELECT id, tile_kind FROM kinds WHERE tile_kind IN ('gt', 'fp') UNION ALL SELECT id, tile_kind FROM (SELECT *, row_number() OVER (ORDER BY {PLACE}, key) AS turn FROM kinds WHERE tile_kind = 'empty'), n WHERE turn <= n""")
def empty_tile_sample(spark, sf_dir):
    return tilesets.with_empty(_few_kinds(spark, sf_dir), keep_oth=False).select("id", "tile_kind")


@query(_with() + f" SELECT id FROM (SELECT id, key, EXISTS (SELECT 1 FROM labels WHERE {FEW} AND {MEET}) AS met FROM tiles) ORDER BY NOT met, key LIMIT 40")
def debug_subset(spark, sf_dir):
    tiles = fixtures.tiles(spark, sf_dir)
    return tilesets.debug_subset(tiles, tilesets.met_ids(tiles, fixtures.labels(spark, sf_dir).where(FEW), assess.LABEL_BOX), 40).select("id")


@query(_with(KIND) + f""", placed AS (SELECT id, tile_kind, row_number() OVER (PARTITION BY tile_kind ORDER BY {PLACE}, key) AS turn, count(*) OVER (PARTITION BY tile_kind) AS n FROM kinds),
sizes AS (SELECT *, CAST(round_even(n * CAST(0.7 AS DOUBLE), 0) AS BIGINT) AS trn FROM placed)
SELECT id, tile_kind, CASE WHEN turn <= trn THEN 'trn' WHEN turn <= trn + round_even((n - trn) * CAST(0.5 AS DOUBLE), 0) THEN 'val' ELSE 'tst' END AS dataset FROM sizes""")
def split_sizes(spark, sf_dir):
    """Each kind of tiles in sets of exactly the wanted sizes."""
    return tilesets.split_sizes(_kinds(spark, sf_dir), by="tile_kind").select("id", "tile_kind", "dataset")


@query(_with() + " SELECT id FROM tiles WHERE key % 2 = 0 INTERSECT SELECT id FROM tiles WHERE key % 3 = 0 INTERSECT SELECT id FROM tiles WHERE key > 10")
def common_tiles(spark, sf_dir):
    tiles = fixtures.tiles(spark, sf_dir)
    return tilesets.common_ids(tiles.where("key % 2 = 0"), tiles.where("key % 3 = 0"), tiles.where("key > 10"))


@query(_with() + f", cut AS (SELECT category, {SPLIT} AS dataset FROM tiles JOIN labels ON {MEET}) SELECT dataset, category, CAST(count(*) AS BIGINT) AS n FROM cut GROUP BY ALL")
def class_occurrence(spark, sf_dir):
    return tilesets.class_occurrence(labels_per_tile(spark, sf_dir), tilesets.split(fixtures.tiles(spark, sf_dir)), "category")


@query(_with() + " SELECT category, count(*) AS n FROM labels GROUP BY category")
def labels_by_category(spark, sf_dir):
    return fixtures.labels(spark, sf_dir).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


SEEDED = f"""
met AS (SELECT key, category, s AS seed, (key * 7919 + s * 104729) % 1000003 % 1000 AS p FROM tiles JOIN labels ON {MEET}, (SELECT unnest(range(0, 50)) AS s)),
per AS (SELECT seed, category, count(*) FILTER (p < 700) AS a, count(*) FILTER (p >= 700 AND p < 850) AS b, count(*) FILTER (p >= 850) AS c, CAST(count(*) AS DOUBLE) AS n FROM met GROUP BY seed, category),
best AS (SELECT seed FROM per GROUP BY seed ORDER BY sum(CAST(a / n >= 0.60 AS INT) + CAST(b / n >= 0.12 AS INT) + CAST(c / n >= 0.12 AS INT) - CAST(a = 0 OR b = 0 OR c = 0 AS INT)) DESC, seed LIMIT 1)"""


@query(_with(SEEDED) + " SELECT id, CASE WHEN p < 700 THEN 'trn' WHEN p < 850 THEN 'val' ELSE 'tst' END AS dataset FROM (SELECT id, (key * 7919 + seed * 104729) % 1000003 % 1000 AS p FROM tiles, best)")
def chosen_split(spark, sf_dir):
    tiles = fixtures.tiles(spark, sf_dir)
    counts = labels_per_tile(spark, sf_dir).join(tiles.select("id", "key"), "id")
    return tilesets.chosen_split(tiles, counts, "category").select("id", "dataset")


@query(
    _with()
    + ", cut AS (SELECT category, " + SPLIT + f" AS part FROM tiles JOIN labels ON {MEET}) SELECT category, "
    + ", ".join(f"count(*) FILTER (part = '{d}') / CAST(count(*) AS DOUBLE) AS {d}_ratio" for d in ("trn", "val", "tst")) + " FROM cut GROUP BY category"
)
def split_ratios(spark, sf_dir):
    tiles = fixtures.tiles(spark, sf_dir)
    return tilesets.split_ratios(labels_per_tile(spark, sf_dir), tilesets.split(tiles), "category")


@query(
    _with()
    + f""", met AS (SELECT key, category, s AS seed, (key * 7919 + s * 104729) % 1000003 % 1000 AS p FROM tiles JOIN labels ON {MEET}, (SELECT unnest(range(0, 50)) AS s)),
per AS (SELECT seed, category, count(*) FILTER (p < 700) AS a, count(*) FILTER (p >= 700 AND p < 850) AS b, count(*) FILTER (p >= 850) AS c, CAST(count(*) AS DOUBLE) AS n FROM met GROUP BY seed, category)
SELECT CAST(seed AS INTEGER) AS seed, CAST(sum(CAST(a / n >= 0.60 AS INT) + CAST(b / n >= 0.12 AS INT) + CAST(c / n >= 0.12 AS INT) - CAST(a = 0 OR b = 0 OR c = 0 AS INT)) AS BIGINT) AS score FROM per GROUP BY seed"""
)
def seed_search(spark, sf_dir):
    counts = labels_per_tile(spark, sf_dir).join(fixtures.tiles(spark, sf_dir).select("id", "key"), "id")
    return tilesets.seed_scores(counts, "category")


@query("SELECT CAST(row_number() OVER (ORDER BY o_orderpriority) AS INTEGER) AS id, o_orderpriority AS name FROM (SELECT DISTINCT o_orderpriority FROM orders)")
def category_ids(spark, sf_dir):
    return tilesets.category_ids(fixtures.labels(spark, sf_dir).withColumn("supercategory", F.lit("foo"))).select("id", "name")


@query(_with() + " SELECT id, CAST(tx AS INTEGER) AS x, CAST(ty AS INTEGER) AS y, 18 AS z FROM tiles")
def tile_id_parse(spark, sf_dir):
    return fixtures.tiles(spark, sf_dir).withColumn("p", names.parse_tile_id(F.col("id"))).select("id", "p.x", "p.y", "p.z")


@query(_with() + " SELECT '18_' || tx || '_' || ty || '.tif' AS file, id FROM tiles")
def file_to_id(spark, sf_dir):
    return fixtures.tiles(spark, sf_dir).select(F.format_string("18_%d_%d.tif", "tx", "ty").alias("file")).withColumn("id", names.file_to_id(F.col("file")))


@query(_with() + " SELECT key, id FROM tiles")
def title_regex(spark, sf_dir):
    return fixtures.tiles(spark, sf_dir).select("key", names.title_to_id(F.format_string("XYZ tile x=%d, y=%d, z=18", "tx", "ty")).alias("id"))


@query(_with() + " SELECT key, 'https://example.org/18/' || tx || '/' || ty || '.jpeg' AS url, 'jpg' AS format FROM tiles")
def xyz_url(spark, sf_dir):
    url = names.fill_address("https://example.org/{z}/{x}/{y}.jpeg", z=F.lit(18), x=F.col("tx"), y=F.col("ty"))
    return fixtures.tiles(spark, sf_dir).select("key", url.alias("url")).withColumn("format", names.image_format(F.col("url")))


@query(f"SELECT event_id, CAST(floor((lon + 180) / 360 * 262144) AS BIGINT) AS x, CAST(floor((0.5 - ln((1 + sin(radians(lat))) / (1 - sin(radians(lat)))) / (4 * pi())) * 262144) AS BIGINT) AS y FROM ({POINTS})")
def mercator_tile(spark, sf_dir):
    x, y = geometry.mercator_tile(F.col("lon"), F.col("lat"), 18)
    return fixtures.points(spark, sf_dir).select("event_id", x.alias("x"), y.alias("y"))


def _rows_sql(lat: str) -> str:
    return f"CAST(floor((0.5 - ln((1 + sin(radians({lat}))) / (1 - sin(radians({lat})))) / (4 * pi())) * 16384) AS BIGINT)"


@query(
    f"""WITH ends AS (SELECT CAST(floor((lon + 180) / 360 * 16384) AS BIGINT) AS x0, CAST(floor((lon + CAST(0.002 AS DOUBLE) + 180) / 360 * 16384) AS BIGINT) AS x1, {_rows_sql('(lat + CAST(0.002 AS DOUBLE))')} AS y0, {_rows_sql('lat')} AS y1 FROM ({POINTS})),
wide AS (SELECT unnest(generate_series(x0, x1)) AS x, y0, y1 FROM ends), tiled AS (SELECT DISTINCT x, unnest(generate_series(y0, y1)) AS y FROM wide)
SELECT x, y, '(' || x || ', ' || y || ', 14)' AS id FROM tiled"""
)
def bbox_cover(spark, sf_dir):
    box = fixtures.points(spark, sf_dir).select(F.col("lon").alias("west"), F.col("lat").alias("south"), (F.col("lon") + 0.002).alias("east"), (F.col("lat") + 0.002).alias("north"))
    return grids.cover(box, 14)


@query(
    f"""SELECT event_id, array_to_string([substr('0123456789bcdefghjkmnpqrstuvwxyz', CAST(list_sum([((CASE WHEN k % 2 = 0 THEN x >> (29 - k // 2) ELSE y >> (29 - k // 2) END) & 1) * (16 >> (k % 5)) FOR k IN range(5 * c, 5 * c + 5)]) AS INTEGER) + 1, 1) FOR c IN range(0, 12)], '') AS geohash
FROM (SELECT event_id, CAST(floor((lon + 180) / 360 * 1073741824) AS BIGINT) AS x, CAST(floor((lat + 90) / 180 * 1073741824) AS BIGINT) AS y FROM ({POINTS}))"""
)
def geohash12(spark, sf_dir):
    return fixtures.points(spark, sf_dir).select("event_id", geometry.geohash(F.col("lon"), F.col("lat")).alias("geohash"))


@query("SELECT key, c AS col, r AS row, c * 448 AS px0, r * 448 AS py0 FROM (SELECT CAST(p_partkey AS BIGINT) AS key, 1000 + CAST(p_partkey AS BIGINT) % 700 AS w, 800 + CAST(p_partkey AS BIGINT) % 300 AS h FROM part), (SELECT CAST(unnest(range(0, 6)) AS INTEGER) AS c), (SELECT CAST(unnest(range(0, 6)) AS INTEGER) AS r) WHERE c < ceil((w - 64) / 448.0) AND r < ceil((h - 64) / 448.0)")
def grid_cells(spark, sf_dir):
    images = fixtures.tiles(spark, sf_dir).select("key", (1000 + F.col("key") % 700).alias("w"), (800 + F.col("key") % 300).alias("h"))
    return grids.pixel_grid(images, "w", "h", 512, 64).select("key", "col", "row", "px0", "py0")


@query(_with(EMPTY) + f""", cut AS (SELECT id, tile_kind, CASE tile_kind WHEN 'gt' THEN 700 WHEN 'fp' THEN 600 WHEN 'empty' THEN 800 END AS trn, {PLACE} % 1000 AS p FROM kinds)
SELECT id, CASE WHEN trn IS NULL THEN 'oth' WHEN p < trn THEN 'trn' WHEN p < (trn + 1000) // 2 THEN 'val' ELSE 'tst' END AS dataset FROM cut""")
def split_kinds(spark, sf_dir):
    return tilesets.split_kinds(_few_kinds(spark, sf_dir), fractions={"gt": 0.7, "fp": 0.6, "empty": 0.8}).select("id", "dataset")


def _tiles_sql(rule: str, years: str) -> str:
    size = "CAST(0.002 AS DOUBLE)"
    return f"""(SELECT DISTINCT x, unnest(generate_series(y0, y1)) AS y, year FROM (SELECT unnest(generate_series(CAST(floor((lon + 180) / 360 * 16384) AS BIGINT), CAST(floor((lon + {size} + 180) / 360 * 16384) AS BIGINT))) AS x,
  {_rows_sql(f'(lat + {size})')} AS y0, {_rows_sql('lat')} AS y1, {years} AS year FROM ({POINTS}) WHERE {rule}))"""


@query(
    f"""WITH labels AS {_tiles_sql('event_id % 3 = 0', 'CAST(2018 + event_id % 4 AS INTEGER)')}, fps AS {_tiles_sql('event_id % 7 = 1', 'CAST(2018 + event_id % 4 AS INTEGER)')}, empties AS {_tiles_sql('event_id % 5 = 2', '2020')},
every AS (SELECT * FROM labels UNION SELECT * FROM fps)
SELECT '(' || year || ', ' || x || ', ' || y || ', 14)' AS id, year, EXISTS (SELECT 1 FROM every e WHERE e.x = t.x AND e.y = t.y) AS labelled, EXISTS (SELECT 1 FROM fps e WHERE e.x = t.x AND e.y = t.y) AS fp,
  round(x / CAST(16384 AS DOUBLE) * 360 - 180, 7) AS west, round(degrees(2 * atan(exp(pi() * (1 - 2 * (y + 1) / CAST(16384 AS DOUBLE)))) - pi() / 2), 7) AS south FROM (SELECT * FROM every UNION SELECT * FROM empties) t"""
)
def tiling_job(spark, sf_dir):
    """Labels, false positives and areas for empty tiles of several years."""
    e = F.col("event_id")
    boxes = fixtures.points(spark, sf_dir).select("event_id", F.col("lon").alias("west"), F.col("lat").alias("south"), (F.col("lon") + 0.002).alias("east"), (F.col("lat") + 0.002).alias("north"))
    dated = boxes.withColumn("year", (2018 + e % 4).cast("int"))
    found = grids.tiling(dated.where(e % 3 == 0), 14, dated.where(e % 7 == 1), boxes.where(e % 5 == 2), 2020)
    return found.select("id", "year", "labelled", "fp", F.round("west", 7).alias("west"), F.round("south", 7).alias("south"))


IMAGE_BOX = ("i_x0", "i_y0", "i_x1", "i_y1")
IMAGES = """
images AS (SELECT key, key * 1000 AS x0, CAST(0 AS DOUBLE) AS y0, key * 1000 + w * CAST(0.125 AS DOUBLE) AS x1, h * CAST(0.125 AS DOUBLE) AS y1, w, h FROM (SELECT CAST(p_partkey AS BIGINT) AS key, 1000 + CAST(p_partkey AS BIGINT) % 700 AS w, 800 + CAST(p_partkey AS BIGINT) % 300 AS h FROM part)),
strips AS (SELECT key, x1, y1, x0, x1 + (CAST(ceil(w / CAST(256 AS DOUBLE)) AS BIGINT) * 256 - w) * CAST(0.125 AS DOUBLE) AS x2, y1 + (CAST(ceil(h / CAST(256 AS DOUBLE)) AS BIGINT) * 256 - h) * CAST(0.125 AS DOUBLE) AS y2 FROM images),
padded AS (SELECT key, 10001 AS id_nodata_poly, CAST(x0 AS DOUBLE) AS n_x0, y1 AS n_y0, x2 AS n_x1, y2 AS n_y1 FROM strips UNION ALL SELECT key, 10002, x1, CAST(0 AS DOUBLE), x2, y1 FROM strips)"""


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h, zero = 1000 + F.col("key") % 700, 800 + F.col("key") % 300, F.lit(0.0)
    return fixtures.tiles(spark, sf_dir).select("key", (F.col("key") * 1000).alias("i_x0"), zero.alias("i_y0"), (F.col("key") * 1000 + w * 0.125).alias("i_x1"), (h * 0.125).alias("i_y1"), w.alias("w"), h.alias("h"), F.lit(0.125).alias("pixel"))


@query("WITH " + IMAGES + " SELECT * FROM padded")
def padding_strips(spark, sf_dir):
    found = grids.padding(_images(spark, sf_dir), IMAGE_BOX, "key", "w", "h", "pixel")
    return found.withColumn("n_x0", F.col("n_x0").cast("double"))


def _shared_sql(a: str, b: str) -> str:
    return f"greatest(least({a}x1, {b}x1) - greatest({a}x0, {b}x0), 0) * greatest(least({a}y1, {b}y1) - greatest({a}y0, {b}y0), 0)"


#: Holes in the images, which may overlap: their common part counts once. The strips beside an image overlap nothing.
SUBTILES = f"""
holes AS (SELECT key, 1 AS sign, x0, CAST(0 AS DOUBLE) AS y0, x0 + key % 100 AS x1, CAST(64 AS DOUBLE) AS y1 FROM images UNION ALL SELECT key, 1, x0 + 10, 32, x0 + 110, 96 FROM images WHERE key % 2 = 0
  UNION ALL SELECT key, -1, x0 + 10, 32, x0 + key % 100, 64 FROM images WHERE key % 2 = 0 AND key % 100 > 10 UNION ALL SELECT key, 1, n_x0, n_y0, n_x1, n_y1 FROM padded),
cells AS (SELECT key, side, x1 AS i_x1, y1 AS i_y1, x0 + c * side * CAST(0.125 AS DOUBLE) AS x0, r * side * CAST(0.125 AS DOUBLE) AS y0, x0 + (c + 1) * side * CAST(0.125 AS DOUBLE) AS x1, (r + 1) * side * CAST(0.125 AS DOUBLE) AS y1, c * side // 512 AS lc, r * side // 512 AS lr
  FROM images, (SELECT unnest([512, 256]) AS side), (SELECT unnest(range(0, 8)) AS c), (SELECT unnest(range(0, 8)) AS r) WHERE c * side < w AND r * side < h),
shares AS (SELECT c.*, 1 - coalesce((SELECT sum(sign * {_shared_sql('c.', 'h.')}) FROM holes h WHERE h.key = c.key), 0) / ((c.x1 - c.x0) * (c.y1 - c.y0)) AS open FROM cells c),
large AS (SELECT * FROM shares WHERE side = 512 AND open > 0.5),
kept AS (SELECT * FROM large UNION ALL SELECT * FROM shares s WHERE side = 256 AND open > 0.25 AND NOT EXISTS (SELECT 1 FROM large l WHERE l.key = s.key AND l.lc = s.lc AND l.lr = s.lr))"""


@query("WITH " + ",".join([IMAGES, SUBTILES]) + " SELECT key, CAST(side AS INTEGER) AS side, '(' || CAST(round_even(x0, 0) AS BIGINT) || ', ' || CAST(round_even(y0, 0) AS BIGINT) || ', ' || key || ')' AS id, x0 AS c_x0, y0 AS c_y0, least(x1, i_x1) AS c_x1, least(y1, i_y1) AS c_y1 FROM kept")
def sub_tiles(spark, sf_dir):
    images = _images(spark, sf_dir)
    box = lambda *b: [F.lit(v).cast("double").alias(n) if not hasattr(v, "cast") else v.cast("double").alias(n) for v, n in zip(b, grids.HOLE_BOX, strict=True)]
    low, more = F.col("i_x0"), F.col("key") % 100
    holes = images.select("key", *box(low, 0, low + more, 64)).unionByName(images.where("key % 2 = 0").select("key", *box(low + 10, 32, low + 110, 96)))
    strips = padding_strips(spark, sf_dir).drop("id_nodata_poly")
    return grids.sub_tiles(images, IMAGE_BOX, "key", "w", "h", "pixel", holes.unionByName(strips), cell=64)


@query("SELECT CAST(event_id AS BIGINT) AS event_id, event_id || '_' || CAST(round_even(lon * 8, 0) AS BIGINT) || '_' || CAST(round_even(lat, 0) AS BIGINT) || '.tif' AS name FROM (" + POINTS + ")")
def box_names(spark, sf_dir):
    return fixtures.points(spark, sf_dir).select("event_id", names.box_name(F.col("event_id"), F.col("lon") * 8, F.col("lat")).alias("name"))


@query(_with() + " SELECT id, 'https://tiles/' || year_tile || '/18/' || tx || '/' || ty || '.jpeg' AS url, year_tile || '_18_' || tx || '_' || ty || '.jpg' AS img_file FROM (SELECT *, 2015 + key % 6 AS year_tile FROM tiles)")
def xyz_tasks(spark, sf_dir):
    tiles = fixtures.tiles(spark, sf_dir).select("id", F.col("tx").alias("x"), F.col("ty").alias("y"), F.lit(18).alias("z"), (2015 + F.col("key") % 6).alias("year_tile"))
    return connectors.xyz_tasks(tiles, "https://tiles/{year}/{z}/{x}/{y}.jpeg", "multi-year").select("id", "url", "img_file")


@query(_with() + " SELECT CAST(row_number() OVER (ORDER BY turn, key) - 1 AS INTEGER) AS det_id, key, dataset, CAST((x1 - x0) * (y1 - y0) AS BIGINT) AS area, score FROM (SELECT 0 AS turn, det_id AS key, 'oth' AS dataset, d_x0 AS x0, d_y0 AS y0, d_x1 AS x1, d_y1 AS y1, score FROM dets UNION ALL SELECT 1, label_id, 'trn', l_x0, l_y0, l_x1, l_y1, NULL FROM labels)")
def stacked_detections(spark, sf_dir):
    """A set with scores before one without; positions run through both."""
    box = ("x0", "y0", "x1", "y1")
    dets = fixtures.detections(spark, sf_dir).select(F.col("det_id").alias("key"), *(F.col(f"d_{c}").alias(c) for c in box), "score")
    labels = fixtures.labels(spark, sf_dir).select(F.col("label_id").alias("key"), *(F.col(f"l_{c}").alias(c) for c in box))
    return enrich.stack_detections({"oth": dets, "trn": labels}, "key", box).select("det_id", "key", "dataset", "area", "score")


CLIP = f"""
clipped AS (SELECT id, label_id, category, t_x0, t_y1, greatest(t_x0, l_x0) AS c_x0, greatest(t_y0, l_y0) AS c_y0, least(t_x1, l_x1) AS c_x1, least(t_y1, l_y1) AS c_y1 FROM tiles JOIN labels ON {MEET}),
parts AS (SELECT * FROM clipped WHERE c_x1 > c_x0 AND c_y1 > c_y0)"""


def _clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coco.clip_boxes(fixtures.tiles(spark, sf_dir), tilesets.TILE_BOX, fixtures.labels(spark, sf_dir), assess.LABEL_BOX)


@query(_with(CLIP) + " SELECT id, label_id, c_x0, c_y0, c_x1, c_y1 FROM parts")
def clip_boxes(spark, sf_dir):
    return _clipped(spark, sf_dir).select("id", "label_id", "c_x0", "c_y0", "c_x1", "c_y1")


def _pixel(c: str) -> str:
    return f"(({c} - t_x0) / CAST(100 AS DOUBLE) * 256)" if "x" in c else f"((t_y1 - {c}) / CAST(100 AS DOUBLE) * 256)"


@query(_with(CLIP) + f" SELECT id, label_id, {_pixel('c_x0')} AS bx, {_pixel('c_y1')} AS by, round(({_pixel('c_x1')} - {_pixel('c_x0')}) * ({_pixel('c_y0')} - {_pixel('c_y1')}), 6) AS area FROM parts")
def coco_bbox_area(spark, sf_dir):
    found = coco.annotations(_clipped(spark, sf_dir), tilesets.TILE_BOX, 256, 256)
    return found.select("id", "label_id", F.col("bbox")[0].alias("bx"), F.col("bbox")[1].alias("by"), F.round("area", 6).alias("area"))


@query(_with(CLIP) + f", sets AS (SELECT key, id, {SPLIT} AS dataset FROM tiles) SELECT s.dataset, key, label_id, CAST(row_number() OVER (PARTITION BY s.dataset ORDER BY key, label_id) AS INTEGER) AS id FROM parts JOIN sets s USING (id)")
def coco_ids(spark, sf_dir):
    tiles = tilesets.split(fixtures.tiles(spark, sf_dir))
    found = coco.clip_boxes(tiles.withColumnRenamed("id", "tile").withColumnRenamed("dataset", "part"), tilesets.TILE_BOX, fixtures.labels(spark, sf_dir), assess.LABEL_BOX)
    return coco.number(found.select(F.col("part").alias("dataset"), "key", "label_id"), "dataset", "key", "label_id").select("dataset", "key", "label_id", "id")


@query(_with(CLIP) + f""", sets AS (SELECT key, id, {SPLIT} AS dataset FROM tiles),
pictures AS (SELECT dataset, count(*) AS images FROM sets GROUP BY dataset),
found AS (SELECT dataset, count(*) AS annotations, round(sum(({_pixel('c_x1')} - {_pixel('c_x0')}) * ({_pixel('c_y0')} - {_pixel('c_y1')})), 3) AS area, count(DISTINCT id) AS used FROM parts JOIN sets USING (id) GROUP BY dataset)
SELECT dataset, images, CAST(images AS INTEGER) AS last_image, coalesce(annotations, 0) AS annotations, CAST(annotations AS INTEGER) AS last_annotation, area, coalesce(used, 0) AS used FROM pictures LEFT JOIN found USING (dataset)""")
def coco_documents(spark, sf_dir):
    """Documents written in lines by many tasks, read back."""
    tiles = tilesets.split(fixtures.tiles(spark, sf_dir))
    images = coco.number(tiles.select("dataset", "key", F.lit(256).alias("width"), F.lit(256).alias("height"), F.concat("dataset", F.lit("-images/18_"), "tx", F.lit("_"), "ty", F.lit(".tif")).alias("file_name"), F.lit(None).cast("int").alias("year")), "dataset", "key")
    found = coco.clip_boxes(tiles.withColumnRenamed("dataset", "part").drop("id"), tilesets.TILE_BOX, fixtures.labels(spark, sf_dir).drop("dataset"), assess.LABEL_BOX)
    notes = coco.annotations(found, tilesets.TILE_BOX, 256, 256).withColumnRenamed("part", "dataset").join(images.select("key", F.col("id").alias("image_id")), "key")
    notes = coco.number(notes.withColumn("category_id", F.col("label_class")), "dataset", "key", "label_id")
    kinds = tilesets.category_ids(fixtures.labels(spark, sf_dir).withColumn("supercategory", F.lit("foo")))
    path = f"{checkpoint_dir(spark).rstrip('/')}/documents-{uuid.uuid4().hex}"
    coco.write_documents(coco.fragments(images, notes, kinds, {"year": 2024, "version": "1.0", "description": "tiles", "contributor": "", "url": ""}, "none", ""), path)
    return coco.read_documents(spark, path).groupBy("dataset").agg(
        F.count("image").alias("images"), F.max("image.id").alias("last_image"), F.count("annotation").alias("annotations"), F.max("annotation.id").alias("last_annotation"),
        F.round(F.sum("annotation.area"), 3).alias("area"), F.count_distinct("annotation.image_id").alias("used"),
    )


@query(_with(NOTCHED) + """ SELECT id, label_id, CAST(CASE WHEN base > 0 THEN 1 ELSE CAST(west > 0 AS INTEGER) + CAST(east > 0 AS INTEGER) END AS BIGINT) AS outlines,
round(CAST(base + west + east AS DOUBLE) * 6.5536, 3) AS area FROM cut WHERE base + west + east > 0""")
def coco_polygons(spark, sf_dir):
    """Notched labels as annotations of one or two outlines."""
    parts = shapes.clip_polygons(_notched(spark, sf_dir), "ring", fixtures.tiles(spark, sf_dir), tilesets.TILE_BOX)
    found = coco.polygon_annotations(parts, "ring", tilesets.TILE_BOX, 256, 256, "id", "label_id")
    return found.select("id", "label_id", F.size("segmentation").cast("long").alias("outlines"), F.round("area", 3).alias("area"))


DENSE = """
dense AS (SELECT * FROM dets),
links AS MATERIALIZED (SELECT a.det_id AS a, b.det_id AS b FROM dense a JOIN dense b ON a.det_id <> b.det_id AND a.d_x0 <= b.d_x1 AND b.d_x0 <= a.d_x1 AND a.d_y0 <= b.d_y1 AND b.d_y0 <= a.d_y1
  WHERE 2 * greatest(least(a.d_x1, b.d_x1) - greatest(a.d_x0, b.d_x0), 0) * greatest(least(a.d_y1, b.d_y1) - greatest(a.d_y0, b.d_y0), 0)
  >= a.w * a.h + b.w * b.h - greatest(least(a.d_x1, b.d_x1) - greatest(a.d_x0, b.d_x0), 0) * greatest(least(a.d_y1, b.d_y1) - greatest(a.d_y0, b.d_y0), 0)),
reach(a, b) AS (SELECT det_id, det_id FROM dense UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
named AS (SELECT a AS det_id, min(b) AS component FROM reach GROUP BY a)"""


@query("WITH RECURSIVE " + ",".join([SQL, DENSE]) + " SELECT det_id, component FROM named")
def overlap_components(spark, sf_dir):
    dets = fixtures.detections(spark, sf_dir)
    return post.groups(dets, post.overlapping(dets)).select("det_id", "component")


@query("WITH RECURSIVE " + ",".join([SQL, DENSE]) + " SELECT det_id, score FROM named JOIN dense USING (det_id) QUALIFY row_number() OVER (PARTITION BY component ORDER BY score DESC, det_id) = 1")
def overlap_keep(spark, sf_dir):
    return post.suppress_overlaps(fixtures.detections(spark, sf_dir)).select("det_id", "score")


MERGE = """
dense AS (SELECT * FROM dets),
links AS MATERIALIZED (SELECT a.det_id AS a, b.det_id AS b FROM dense a JOIN dense b ON a.det_id <> b.det_id AND a.year_det = b.year_det AND a.d_x0 - 2 <= b.d_x1 + 2 AND b.d_x0 - 2 <= a.d_x1 + 2 AND a.d_y0 - 2 <= b.d_y1 + 2 AND b.d_y0 - 2 <= a.d_y1 + 2),
reach(a, b) AS (SELECT det_id, det_id FROM dense UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
named AS (SELECT a AS det_id, min(b) AS component FROM reach GROUP BY a),
joined AS (SELECT * FROM named JOIN dense USING (det_id)),
areas AS (SELECT component, det_class, sum(w * h) AS area FROM joined GROUP BY ALL),
kinds AS (SELECT component, det_class FROM areas QUALIFY row_number() OVER (PARTITION BY component ORDER BY area DESC, det_class) = 1)"""


MERGED = "component, any_value(j.year_det) AS year_det, any_value(k.det_class) AS det_class, count(*) AS n, CAST(min(d_x0) AS BIGINT) AS m_x0, CAST(min(d_y0) AS BIGINT) AS m_y0, CAST(max(d_x1) AS BIGINT) AS m_x1, CAST(max(d_y1) AS BIGINT) AS m_y1 FROM joined j JOIN kinds k USING (component) GROUP BY component"


@query("WITH RECURSIVE " + ",".join([SQL, MERGE]) + " SELECT CAST(round(avg(score), 6) AS DOUBLE) AS score, " + MERGED)
def merge_adjacent(spark, sf_dir):
    """The mean score is rounded here: its last digits depend on the order of rows."""
    return post.merge_adjacent(fixtures.detections(spark, sf_dir), 2).withColumn("score", F.round("score", 6))


def _reach(name: str, links: str, nodes: str) -> str:
    """Each node of nodes with the least one that it reaches by links (a, b)."""
    return f"""
{name}_reach(a, b) AS (SELECT id, id FROM {nodes} UNION SELECT r.a, l.b FROM {name}_reach r JOIN {links} l ON r.b = l.a),
{name} AS (SELECT a AS id, min(b) AS component FROM {name}_reach GROUP BY a)"""


def _beside(d: int) -> str:
    """That boxes a and b of one year, moved outwards by d, share area or a stretch of a side."""
    wide, high = (f"least(a.d_{c}1, b.d_{c}1) - greatest(a.d_{c}0, b.d_{c}0) + {2 * d}" for c in "xy")
    return f"a.det_id <> b.det_id AND a.year_det = b.year_det AND {wide} >= 0 AND {high} >= 0 AND ({wide} > 0 OR {high} > 0)"


#: Pieces of detections, those within a tile, and the others grown by 2, united and shrunk by 2 as runs of unit cells.
ACROSS = f"""
nodes AS (SELECT det_id AS id FROM dets),
whole_links AS MATERIALIZED (SELECT a.det_id AS a, b.det_id AS b FROM dets a JOIN dets b ON {_beside(0)}),{_reach('whole', 'whole_links', 'nodes')},
bounds AS (SELECT component, min(d_x0) - 2 AS b_x0, min(d_y0) - 2 AS b_y0, max(d_x1) + 2 AS b_x1, max(d_y1) + 2 AS b_y1 FROM whole JOIN dets ON id = det_id GROUP BY component),
inner_ones AS MATERIALIZED (SELECT component FROM bounds WHERE EXISTS (SELECT 1 FROM tiles WHERE tx = b_x0 // 100 AND ty = b_y0 // 100 AND b_x0 >= t_x0 AND b_y0 >= t_y0 AND b_x1 <= t_x1 AND b_y1 <= t_y1)),
crossing AS MATERIALIZED (SELECT dets.* FROM dets JOIN whole ON id = det_id WHERE component NOT IN (SELECT component FROM inner_ones)),
cross_nodes AS (SELECT det_id AS id FROM crossing),
cross_links AS MATERIALIZED (SELECT a.det_id AS a, b.det_id AS b FROM crossing a JOIN crossing b ON {_beside(2)}),{_reach('united', 'cross_links', 'cross_nodes')},
wide AS (SELECT DISTINCT component AS g, x, y FROM (SELECT component, x, unnest(range(d_y0 - 2, d_y1 + 2)) AS y FROM (SELECT component, unnest(range(d_x0 - 2, d_x1 + 2)) AS x, d_y0, d_y1 FROM united JOIN crossing ON id = det_id))),
flat AS (SELECT g, y, unnest(range(min(x) + 2, max(x) - 1)) AS x FROM (SELECT *, x - row_number() OVER (PARTITION BY g, y ORDER BY x) AS island FROM wide) GROUP BY g, y, island),
cells AS MATERIALIZED (SELECT g, x, unnest(range(min(y) + 2, max(y) - 1)) AS y FROM (SELECT *, y - row_number() OVER (PARTITION BY g, x ORDER BY y) AS island FROM flat) GROUP BY g, x, island),
runs AS MATERIALIZED (SELECT row_number() OVER (ORDER BY g, y, min(x)) AS id, g, y, min(x) AS a, max(x) + 1 AS b FROM (SELECT *, x - row_number() OVER (PARTITION BY g, y ORDER BY x) AS island FROM cells) GROUP BY g, y, island),
run_links AS MATERIALIZED (SELECT r.id AS a, s.id AS b FROM runs r JOIN runs s ON r.g = s.g AND abs(r.y - s.y) = 1 AND r.a < s.b AND s.a < r.b),{_reach('pieces', 'run_links', 'runs')},
placed AS (SELECT runs.*, component AS piece FROM runs JOIN pieces USING (id)),
starts AS (SELECT g, piece, CAST(sum(b - a) AS DOUBLE) AS area, min([a, y]) AS start FROM placed GROUP BY g, piece),
numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY g ORDER BY start) - 1 AS INTEGER) AS part FROM starts),
years AS (SELECT component AS g, any_value(year_det) AS year_det FROM united JOIN dets ON id = det_id GROUP BY component),
met AS (SELECT DISTINCT g, piece, d.* FROM placed p JOIN years USING (g) JOIN dets d ON d.year_det = years.year_det AND d_x0 <= p.b AND p.a <= d_x1 AND d_y0 <= p.y + 1 AND p.y <= d_y1),
kinds AS (SELECT g, piece, det_class, sum(w * h) AS area FROM met GROUP BY g, piece, det_class QUALIFY row_number() OVER (PARTITION BY g, piece ORDER BY area DESC, det_class) = 1),
means AS (SELECT g, piece, round(avg(score), 6) AS score, count(*) AS n FROM met GROUP BY ALL)"""


@query("WITH RECURSIVE " + ",".join([SQL, ACROSS]) + " SELECT g AS component, part, met.det_id, met.year_det, numbered.area, kinds.det_class, means.score, n FROM numbered JOIN met USING (g, piece) JOIN kinds USING (g, piece) JOIN means USING (g, piece)")
def merge_across_tiles(spark, sf_dir):
    """A row for each merged piece and each detection that meets it."""
    merged, members, _ = post.merge_across_tiles(fixtures.detections(spark, sf_dir), fixtures.tiles(spark, sf_dir), tilesets.TILE_BOX, 2)
    return merged.join(members, ["component", "year_det", "part"]).select("component", "part", "det_id", "year_det", "area", "det_class", F.round("score", 6).alias("score"), "n")


@query("WITH RECURSIVE " + ",".join([SQL, ACROSS.split("cross_nodes AS")[0].rstrip().rstrip(",")]) + """,
unit AS (SELECT DISTINCT component, x, y FROM (SELECT component, x, unnest(range(d_y0, d_y1)) AS y FROM (SELECT component, unnest(range(d_x0, d_x1)) AS x, d_y0, d_y1 FROM whole JOIN dets ON id = det_id WHERE component IN (SELECT component FROM inner_ones))))
SELECT component, CAST(count(*) AS DOUBLE) AS area FROM unit GROUP BY component""")
def merge_within_tiles(spark, sf_dir):
    within = post.merge_within_tiles(fixtures.detections(spark, sf_dir), fixtures.tiles(spark, sf_dir), tilesets.TILE_BOX, 2)
    return within.groupBy("component").agg(F.sum("area").alias("area"))


#: Labels clipped by tiles, and their pairs with detections of the same set.
JOB = f"""
sets AS (SELECT tiles.*, {SPLIT} AS dataset FROM tiles),
edged AS (SELECT s.id AS tile, s.dataset, label_class, category, year_label, (t_x0 + t_x1) / CAST(2 AS DOUBLE) - (t_x1 - t_x0) / CAST(2 AS DOUBLE) * CAST(0.9999 AS DOUBLE) AS a0, (t_y0 + t_y1) / CAST(2 AS DOUBLE) - (t_y1 - t_y0) / CAST(2 AS DOUBLE) * CAST(0.9999 AS DOUBLE) AS a1,
  (t_x0 + t_x1) / CAST(2 AS DOUBLE) + (t_x1 - t_x0) / CAST(2 AS DOUBLE) * CAST(0.9999 AS DOUBLE) AS a2, (t_y0 + t_y1) / CAST(2 AS DOUBLE) + (t_y1 - t_y0) / CAST(2 AS DOUBLE) * CAST(0.9999 AS DOUBLE) AS a3, l_x0, l_y0, l_x1, l_y1
  FROM sets s JOIN labels l ON {MEET}),
bits AS (SELECT tile, dataset, label_class, category, year_label, greatest(a0, l_x0) AS l_x0, greatest(a1, l_y0) AS l_y0, least(a2, l_x1) AS l_x1, least(a3, l_y1) AS l_y1 FROM edged),
parted AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY tile, l_x0, l_y0, l_x1, l_y1, label_class) AS label_id FROM bits WHERE l_x1 > l_x0 AND l_y1 > l_y0),
job_pairs AS (SELECT d.*, l.dataset AS l_dataset, label_id, label_class, l_x0, l_y0, l_x1, l_y1,
  greatest(least(d_x1, l_x1) - greatest(d_x0, l_x0), 0) * greatest(least(d_y1, l_y1) - greatest(d_y0, l_y0), 0) AS shared
  FROM dets d JOIN parted l ON d.dataset = l.dataset AND d_x0 <= l_x1 AND l_x0 <= d_x1 AND d_y0 <= l_y1 AND l_y0 <= d_y1),
job_ious AS MATERIALIZED (SELECT *, shared / CAST((d_x1 - d_x0) * (d_y1 - d_y0) + (l_x1 - l_x0) * (l_y1 - l_y0) - shared AS DOUBLE) AS iou FROM job_pairs),"""


def _job_sql(sql: str) -> str:
    """sql of the tables labels and ious over those of the assessment job."""
    return sql.replace("FROM ious", "FROM job_ious").replace("FROM labels", "FROM parted")


JOB_TAGGED = _job_sql(MATCHED)


def _assessed(spark: SparkSession, sf_dir: str, threshold: float | None) -> dict[str, DataFrame]:
    settings = config.load(config.Assessment, {"datasets": {"detections": {}, "split_aoi_tiles": ""}, "metrics_method": "macro-average", "confidence_threshold": threshold})
    labels = fixtures.labels(spark, sf_dir).select("category", F.col("year_label").alias("year"), *assess.LABEL_BOX, "label_class")
    tiles = tilesets.split(fixtures.tiles(spark, sf_dir))
    kinds = labels.select(F.col("label_class").alias("id"), F.col("category").alias("name")).distinct()
    return jobs.assess_detections(settings, fixtures.detections(spark, sf_dir), tiles, labels.where("label_class <= 3"), labels.where("label_class > 3"), kinds)


@query(_with(JOB.rstrip(","), JOB_TAGGED, COUNTS, _score(*MACRO)) + " SELECT * FROM scored")
def assessment_job(spark, sf_dir):
    """The assessment from labels and tiles to global metrics, at a set threshold."""
    return _assessed(spark, sf_dir, THRESHOLD)["global_metrics"]


@query(_with(JOB.rstrip(","), _job_sql(SWEPT), _score(*MACRO, keys="dataset, threshold")) + " SELECT threshold / CAST(100 AS DOUBLE) AS threshold FROM scored WHERE dataset = 'val' ORDER BY f1 DESC, scored.threshold LIMIT 1")
def assessment_threshold(spark, sf_dir):
    """The threshold that the assessment finds by itself on the validation set."""
    return _assessed(spark, sf_dir, None)["threshold"]


@query("WITH RECURSIVE " + ",".join([SQL, ACROSS]) + """ SELECT g AS component, part, numbered.area, years.year_det, kinds.det_class, means.score, n, name AS det_category FROM numbered JOIN kinds USING (g, piece) JOIN means USING (g, piece) JOIN years USING (g)
LEFT JOIN (SELECT DISTINCT label_class - 1 AS det_class, category AS name FROM labels) c ON c.det_class = kinds.det_class WHERE means.score > 0.4""")
def merging_job(spark, sf_dir):
    """Detections of each year merged across tiles, by their score, with the names of their classes."""
    settings = config.load(config.Merging, {"detections": {}, "distance": 2, "score_threshold": 0.4})
    kinds = fixtures.labels(spark, sf_dir).select(F.col("label_class").alias("id"), F.col("category").alias("name")).distinct()
    found = jobs.merge_detections(settings, fixtures.detections(spark, sf_dir), fixtures.tiles(spark, sf_dir), kinds)["detections"]
    return found.select("component", "part", "area", "year_det", "det_class", F.round("score", 6).alias("score"), "n", "det_category")


@query(_with(KIND) + f""", counted AS (SELECT count(*) FILTER (tile_kind = 'gt') AS gt, count(*) FILTER (tile_kind = 'fp') AS fp FROM kinds),
chosen AS (SELECT * FROM kinds WHERE tile_kind <> 'empty' UNION ALL SELECT * EXCLUDE (turn, gt, fp) FROM (SELECT *, row_number() OVER (ORDER BY {PLACE.replace('104729', '5 * 104729')}, key) AS turn FROM kinds WHERE tile_kind = 'empty'), counted WHERE turn <= greatest(0, CAST(trunc(0.5 * (gt - fp)) AS BIGINT))),
cut AS (SELECT *, ({PLACE.replace('104729', '5 * 104729')}) % 1000 AS p, CASE tile_kind WHEN 'fp' THEN 600 ELSE 700 END AS t FROM chosen)
SELECT id, tile_kind, CASE WHEN tile_kind = 'oth' THEN 'oth' WHEN p < t THEN 'trn' WHEN p < t + (1000 - t) // 2 THEN 'val' ELSE 'tst' END AS dataset, 'https://tiles/18/' || tx || '/' || ty || '.png' AS url FROM cut""")
def tileset_job(spark, sf_dir):
    """Tiles of all kinds, a sample of empty ones, the split by a set seed, and the images to fetch."""
    source = {"type": "XYZ", "location": "https://tiles/{z}/{x}/{y}.png"}
    settings = config.load(config.Tilesets, {"output_folder": "", "datasets": {"aoi_tiles": "", "image_source": source, "add_fp_labels": {"fp_labels": "", "frac_trn": 0.6}}, "empty_tiles": {}, "seed": 5})
    labels = fixtures.labels(spark, sf_dir)
    found = jobs.make_tilesets(settings, fixtures.tiles(spark, sf_dir), labels.where("label_class <= 3"), labels.where("label_class = 4 AND label_id % 5 = 0"), labels.where("label_class = 5"))
    return found["tiles"].select("id", "tile_kind", "dataset").join(found["tasks"].select("id", "url"), "id")


CLUSTER = """
grown AS (SELECT *, d_x0 - CAST(0.1 AS DOUBLE) AS g_x0, d_y0 - CAST(0.1 AS DOUBLE) AS g_y0, d_x1 + CAST(0.1 AS DOUBLE) AS g_x1, d_y1 + CAST(0.1 AS DOUBLE) AS g_y1 FROM dets),
near AS MATERIALIZED (SELECT a.det_id AS a, b.det_id AS b, a.score AS sa, b.score AS sb, a.image AS ia, b.image AS ib, a.det_class AS ca, b.det_class AS cb,
  greatest(least(a.g_x1, b.d_x1) - greatest(a.g_x0, b.d_x0), 0) * greatest(least(a.g_y1, b.d_y1) - greatest(a.g_y0, b.d_y0), 0) AS shared, (a.g_x1 - a.g_x0) * (a.g_y1 - a.g_y0) + b.w * b.h AS total
  FROM grown a JOIN grown b ON a.det_id > b.det_id AND a.g_x0 <= b.g_x1 AND b.g_x0 <= a.g_x1 AND a.g_y0 <= b.g_y1 AND b.g_y0 <= a.g_y1),
edges AS MATERIALIZED (SELECT a, b FROM near WHERE ia <> ib AND ca = cb),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(a, b) AS (SELECT det_id, det_id FROM dets UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
named AS (SELECT a AS det_id, min(b) AS component FROM reach GROUP BY a),
tied AS (SELECT DISTINCT a AS id FROM both_ways),
gone AS (SELECT DISTINCT CASE WHEN ta AND NOT tb THEN b WHEN tb AND NOT ta THEN a WHEN sa > sb THEN b ELSE a END AS det_id
  FROM (SELECT *, a IN (SELECT id FROM tied) AS ta, b IN (SELECT id FROM tied) AS tb FROM near WHERE ia = ib AND shared / (total - shared) > 0.75))"""


@query("WITH RECURSIVE " + ",".join([SQL, CLUSTER]) + " SELECT component, det_class, count(*) AS n, median(score) AS score, 500 AS scale FROM named JOIN dets USING (det_id) WHERE det_id NOT IN (SELECT det_id FROM gone) GROUP BY component, det_class")
def cluster_median(spark, sf_dir):
    return post.cluster(fixtures.detections(spark, sf_dir).withColumn("scale", F.lit(500)))


CLUSTERED = """
left_over AS (SELECT d.*, component, det_id IN (SELECT id FROM tied) AS tied FROM dets d JOIN named USING (det_id) WHERE det_id NOT IN (SELECT det_id FROM gone)),
ids AS (SELECT component, CAST(row_number() OVER (ORDER BY component) AS INTEGER) AS cluster_id FROM (SELECT DISTINCT component FROM named WHERE det_id IN (SELECT id FROM tied))),
single AS (SELECT det_id, CAST(NULL AS INTEGER) AS cluster_id, dataset, score, det_class, image, d_x0, d_y0, d_x1, d_y1 FROM left_over WHERE NOT tied),
members AS (SELECT * FROM left_over JOIN ids USING (component) WHERE tied)"""
ONE = "median(score) AS score, min(det_class) AS det_class, arg_min(image, det_id) AS image, min(d_x0) AS d_x0, min(d_y0) AS d_y0, max(d_x1) AS d_x1, max(d_y1) AS d_y1 FROM members"


@query("WITH RECURSIVE " + ",".join([SQL, CLUSTER, CLUSTERED]) + f" SELECT * FROM single UNION ALL SELECT cluster_id + (SELECT max(det_id) FROM left_over), cluster_id, NULL, {ONE} GROUP BY cluster_id")
def cluster_dissolved(spark, sf_dir):
    return post.dissolve_clusters(fixtures.detections(spark, sf_dir).withColumn("scale", F.lit(500))).drop("scale")


@query("WITH RECURSIVE " + ",".join([SQL, CLUSTER, CLUSTERED]) + f" SELECT * FROM single UNION ALL SELECT min(det_id), cluster_id, dataset, {ONE} GROUP BY cluster_id, dataset")
def cluster_datasets(spark, sf_dir):
    return post.dissolve_clusters(fixtures.detections(spark, sf_dir).withColumn("scale", F.lit(500)), keep_datasets=True).drop("scale")


#: Measures of the unit cells (g, x, y) of each g: area, outline, and by squares of four cells the corners; and for a g in one
#: piece the holes, one that touches the outline in a corner too.
MEASURED = """
touched AS (SELECT g, x + dx AS x, y + dy AS y, dx + 2 * dy AS place FROM cells, (SELECT unnest([0, 1]) AS dx), (SELECT unnest([0, 1]) AS dy)),
quads AS (SELECT g, x, y, list_sort(list(place)) AS q FROM touched GROUP BY g, x, y),
corners AS (SELECT g, count(*) FILTER (len(q) = 1) AS one, count(*) FILTER (len(q) = 3) AS three, count(*) FILTER (q = [0, 3] OR q = [1, 2]) AS two,
  count(*) FILTER (len(q) = 2 AND q <> [0, 3] AND q <> [1, 2]) AS straight FROM quads GROUP BY g),
measured AS (SELECT g, (SELECT count(*) FROM cells c WHERE c.g = k.g) AS area, (2 * straight + 2 * one + 2 * three + 4 * two) // 2 AS outline, one + three + 2 * two AS corners, 1 - (one - three - 2 * two) // 4 AS holes FROM corners k)"""


def _measures(polygons: DataFrame, by: str) -> DataFrame:
    """Area, outline and corners as MEASURED gives them, from polygons."""
    points = F.aggregate("polygon", F.lit(0), lambda n, r: n + F.size(r) - 1)
    each = polygons.select(by, "area", outline.perimeter(F.col("polygon")).alias("outline"), points.alias("corners"))
    return each.groupBy(by).agg(*(F.round(F.sum(c)).cast("long").alias(c) for c in ("area", "outline", "corners")))


@query(_with(""" cells AS (SELECT DISTINCT dataset AS g, x, y FROM (SELECT dataset, x, unnest(range(l_y0, l_y1)) AS y FROM (SELECT dataset, unnest(range(l_x0, l_x1)) AS x, l_y0, l_y1 FROM labels)))""", MEASURED) + " SELECT g AS dataset, area, outline, corners FROM measured")
def union_outlines(spark, sf_dir):
    """The outlines of all labels of a dataset: one polygon with thousands of holes, and others around it."""
    return _measures(outline.union_polygons(fixtures.labels(spark, sf_dir), assess.LABEL_BOX, ["dataset"]), "dataset")


@query("WITH RECURSIVE " + ",".join([SQL, CLUSTER, CLUSTERED, """
cells AS (SELECT DISTINCT component AS g, x, y FROM (SELECT component, x, unnest(range(d_y0, d_y1)) AS y FROM (SELECT component, unnest(range(d_x0, d_x1)) AS x, d_y0, d_y1 FROM members)))""", MEASURED]) + " SELECT g AS component, CAST(area AS DOUBLE) AS area, CAST(outline AS DOUBLE) AS outline FROM measured")
def cluster_outlines(spark, sf_dir):
    """The outlines of clusters; boxes of whole numbers have no gap that a tenth would close."""
    found = post.cluster_outlines(fixtures.detections(spark, sf_dir).withColumn("scale", F.lit(500)))
    lengths = found.select("component", "area", outline.perimeter(F.col("polygon")).alias("outline"))
    return lengths.groupBy("component").agg(*(F.round(F.sum(c), 3).alias(c) for c in ("area", "outline")))


@query(
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
m AS (SELECT *, list_reduce(v, lambda a, b: a + b, CAST(0 AS DOUBLE)) / len(v) AS mean FROM v)
SELECT vec_id AS image, 'R' AS band, round_even(mean, 3) + 0.0 AS mean, round_even(sqrt(list_reduce(list_transform(v, lambda x: (x - mean) * (x - mean)), lambda a, b: a + b, CAST(0 AS DOUBLE)) / len(v)), 3) AS std FROM m"""
)
def band_stats(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    key = rows.columns[0]
    return raster.band_stats(rows.select(F.col(key).alias("image"), F.lit("R").alias("band"), "embedding"), "image", "band", "embedding")


#: Pixels of images of 8 by 8, three values, from the embeddings; and mosaics of 5 by 5 of them.
PIXELS = """
pixels AS (SELECT vec_id, v, (i - 1) % 8 AS px, (i - 1) // 8 AS py, CASE WHEN embedding[i] > 0.05 THEN 1 WHEN embedding[i] < -0.2 THEN 2 ELSE 0 END AS value
  FROM (SELECT vec_id, CAST(vec_id AS BIGINT) AS v, embedding, unnest(range(1, 65)) AS i FROM embeddings))"""


def _flood(value: int) -> str:
    """Regions of the pixels (k, px, py, value) of one value, and their unit cells."""
    return f"""
ones AS MATERIALIZED (SELECT k, px, py, (py * 100000 + px) AS id FROM given WHERE value = {value}),
beside AS MATERIALIZED (SELECT p.k, p.id AS a, q.id AS b FROM ones p JOIN ones q ON p.k = q.k AND abs(p.px - q.px) + abs(p.py - q.py) = 1),
reach(k, a, b) AS (SELECT k, id, id FROM ones UNION SELECT r.k, r.a, l.b FROM reach r JOIN beside l ON r.k = l.k AND r.b = l.a),
firsts AS (SELECT k, a AS id, min(b) AS first FROM reach GROUP BY k, a),
named AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY k ORDER BY first) - 1 AS INTEGER) AS region FROM firsts),
cells AS MATERIALIZED (SELECT [k, region] AS g, px AS x, -py AS y FROM named JOIN ones USING (k, id)),{MEASURED}"""


def _images_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = lambda v: F.when(v > 0.05, 1).when(v < -0.2, 2).otherwise(0)
    rows = F.array(*(F.transform(F.slice("embedding", 8 * k + 1, 8), value) for k in range(8)))
    v = F.col("vec_id").cast("long")
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(v.alias("k"), rows.alias("rows"), F.expr("vec_id div 25").alias("mosaic"), (F.expr("vec_id % 25 div 5") * 8).alias("top"), (v % 5 * 8).alias("left"))


@query("WITH RECURSIVE " + PIXELS + ", given AS (SELECT v AS k, px, py, value FROM pixels)," + _flood(1) + " SELECT g[1] AS k, CAST(g[2] AS INTEGER) AS region, CAST(area AS DOUBLE) AS area, CAST(outline AS DOUBLE) AS outline, corners, holes FROM measured")
def mask_outlines(spark, sf_dir):
    """The regions of ones of each image."""
    found = raster.outlines(raster.regions(raster.runs(_images_of(spark, sf_dir), "k").where("value = 1"), "k"), "k")
    corners = F.aggregate("polygon", F.lit(0).cast("long"), lambda n, r: n + F.size(r) - 1)
    return found.select("k", "region", "area", F.round(outline.perimeter(F.col("polygon")), 6).alias("outline"), corners.alias("corners"), (F.size("polygon") - 1).cast("long").alias("holes"))


@query("WITH RECURSIVE " + PIXELS + ", given AS (SELECT v // 25 AS k, px + v % 5 * 8 AS px, py + v % 25 // 5 * 8 AS py, value FROM pixels)," + _flood(0)
       + " SELECT g[1] AS k, CAST(g[2] AS INTEGER) AS id_nodata_poly, area * CAST(0.25 AS DOUBLE) AS area, outline * CAST(0.5 AS DOUBLE) AS outline, holes FROM measured WHERE area * 0.25 > 10")
def nodata_outlines(spark, sf_dir):
    """The large regions without data of mosaics that come in blocks of 8 by 8, half a metre a pixel."""
    images = _images_of(spark, sf_dir).drop("k").withColumnRenamed("mosaic", "k")
    placed = images.select("k").distinct().select("k", (F.col("k") * 100.0).alias("x0"), F.lit(50.0).alias("y1"), F.lit(0.5).alias("dx"), F.lit(0.5).alias("dy"))
    found = raster.nodata_polygons(images, "k", 0, placed, top="top", left="left")
    return found.select("k", "id_nodata_poly", "area", F.round(outline.perimeter(F.col("polygon")), 6).alias("outline"), (F.size("polygon") - 1).cast("long").alias("holes"))


BANDS = """WITH v AS (SELECT vec_id, band, list_transform(embedding[21 * b + 1 : 21 * b + 21], lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings, (VALUES (0, 'R'), (1, 'G'), (2, 'B')) t(b, band)),
m AS (SELECT *, list_reduce(v, lambda a, b: a + b, CAST(0 AS DOUBLE)) / len(v) AS mean FROM v),
s AS (SELECT vec_id, band, round_even(mean, 3) + 0.0 AS mean, round_even(sqrt(list_reduce(list_transform(v, lambda x: (x - mean) * (x - mean)), lambda a, b: a + b, CAST(0 AS DOUBLE)) / len(v)), 3) AS std FROM m)"""


@query(BANDS + " SELECT band, round_even(median(mean), 2) + 0.0 AS mean, round_even(median(std), 2) + 0.0 AS std FROM s GROUP BY band")
def band_summary(spark, sf_dir):
    """Medians over all images of three bands."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    bands = rows.select("vec_id", F.explode(F.array(*(F.struct(F.lit(band).alias("band"), F.slice("embedding", 21 * b + 1, 21).alias("pixels")) for b, band in enumerate("RGB")))).alias("p"))
    return raster.summary_stats(raster.band_stats(bands.select("vec_id", "p.*"), "vec_id", "band", "pixels"), "band")


@query("SELECT c_custkey AS key, c_name AS name, NULL::DOUBLE AS s_acctbal FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def union_by_name(spark, sf_dir):
    a = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    b = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), "s_acctbal")
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT doc_id, lang FROM documents WHERE lang = 'en' UNION ALL SELECT doc_id, lang FROM documents WHERE doc_id % 2 = 0 AND (lang IS NULL OR lang <> 'en')")
def name_upsert(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    return tables.upsert_names(docs.where("lang = 'en'"), docs.where("doc_id % 2 = 0"), "doc_id")


@query("SELECT o_orderkey AS img_file FROM orders WHERE o_orderkey NOT IN (SELECT event_id FROM events)")
def catalog_missing(spark, sf_dir):
    tasks = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("img_file"))
    return tables.missing(tasks, spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("img_file")))


HASHED = """array_to_string([substr('0123456789bcdefghjkmnpqrstuvwxyz', CAST(list_sum([((CASE WHEN k % 2 = 0 THEN x >> (19 - k // 2) ELSE y >> (19 - k // 2) END) & 1) * (16 >> (k % 5)) FOR k IN range(5 * c, 5 * c + 5)]) AS INTEGER) + 1, 1) FOR c IN range(0, 8)], '')"""


@query(_with() + f" SELECT label_id, 'a' || {HASHED} || '_z' AS name FROM (SELECT label_id, CAST(floor(((l_x0 + l_x1) / CAST(64 AS DOUBLE) + 180) / 360 * 1048576) AS BIGINT) AS x, CAST(floor(((l_y0 + l_y1) / CAST(128 AS DOUBLE) + 90) / 180 * 1048576) AS BIGINT) AS y FROM labels)")
def geohash_names(spark, sf_dir):
    """Labels, as if they were on the globe, named by the place of their centre."""
    x0, y0, x1, y1 = (F.col(c) / F.lit(d) for c, d in zip(assess.LABEL_BOX, (32.0, 64.0, 32.0, 64.0), strict=True))
    sides = fixtures.labels(spark, sf_dir).select("label_id", x0.alias("a"), y0.alias("b"), x1.alias("c"), y1.alias("d"))
    return sides.select("label_id", geometry.geohash_name(geometry.box_ring(("a", "b", "c", "d")), "a", "_z", 8).alias("name"))


@query(_with() + f""" SELECT id, dataset || '-images-256/18_' || tx || '_all.tif' AS dst_file, strftime(make_timestamp(CAST(1600000000 + key * 3601 AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%S') AS date_captured, 256 AS width
FROM (SELECT *, {SPLIT} AS dataset FROM tiles)""")
def catalogue_round_trip(spark, sf_dir):
    """A catalogue of images written in lines and read back, with the files' places in their sets and their dates."""
    tiles = tilesets.split(fixtures.tiles(spark, sf_dir))
    images = tiles.select(F.concat(F.lit("all-images-256/18_"), "tx", F.lit("_all.tif")).alias("img_file"), "id", "dataset", F.lit(256).alias("width"), names.captured(1600000000 + F.col("key") * 3601).alias("date_captured"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/catalogue-{uuid.uuid4().hex}"
    connectors.write_catalogue(images, path)
    back = connectors.read_catalogue(spark, path, "id string, dataset string, width int, date_captured string")
    return back.select("id", names.destination(F.col("img_file"), F.col("dataset")).alias("dst_file"), "date_captured", "width")


@query(_with() + " SELECT key, CAST(0.390625 AS DOUBLE) AS a, CAST(t_x0 + 0.1953125 AS DOUBLE) AS cx, CAST(t_y1 - 0.1953125 AS DOUBLE) AS cy FROM tiles")
def world_file(spark, sf_dir):
    lines = F.split(geometry.world_file(tilesets.TILE_BOX, F.lit(256), F.lit(256)), "\n")
    return fixtures.tiles(spark, sf_dir).select("key", lines[0].cast("double").alias("a"), lines[4].cast("double").alias("cx"), lines[5].cast("double").alias("cy"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@query("WITH " + PIXELS + """ SELECT v AS k, CAST(py // 3 * 3 AS INTEGER) AS top, count(*) FILTER (value = 1) AS ones, CAST(sum(value) AS DOUBLE) AS total, CAST(v % 50 AS DOUBLE) * 4 AS x0, CAST(v // 50 AS DOUBLE) * 2 AS y1,
CAST(8 AS INTEGER) AS width, CAST(2056 AS INTEGER) AS epsg FROM pixels GROUP BY ALL""")
def tiff_scan(spark, sf_dir):
    """Images written as TIFF files and read back in strips of three rows, with what their headers say."""
    images = _images_of(spark, sf_dir).select("k", "rows", ((F.col("k") % 50) * 4.0).alias("x0"), (F.expr("k div 50") * 2.0).alias("y1"), F.lit(0.5).alias("d"))
    named = images.withColumn("img_file", F.concat(F.expr("k div 1000"), F.lit("/"), "k", F.lit(".tif")))
    paths = tiff.write_tiffs(named, _folder(spark, "tiff"), place=["x0", "y1", "d", "d"], epsg=2056, strip=3)
    pixels = F.flatten("rows")
    blocks = tiff.tiff_blocks(paths).select("path", "top", F.size(F.filter(pixels, lambda p: p == 1)).cast("long").alias("ones"), F.aggregate(pixels, F.lit(0.0), lambda s, p: s + p).alias("total"))
    found = blocks.join(tiff.tiff_info(paths).select("path", "x0", "y1", "width", "epsg"), "path")
    return found.select(F.regexp_extract("path", r"(\d+)\.tif$", 1).cast("long").alias("k"), "top", "ones", "total", "x0", "y1", "width", "epsg")


#: Plans of labels, and files whose names end in a plan, some with more in front.
PLANS = """
boxes AS (SELECT label_id, CAST(label_id % 50 AS VARCHAR) AS Num_box, lpad(CAST(label_id % 400 AS VARCHAR), 6, '0') || CAST(label_id % 3 AS VARCHAR) AS Num_plan FROM labels),
files AS (SELECT '/plans/' || CASE WHEN key % 2 = 0 THEN 'a_' ELSE '' END || lpad(CAST(key % 400 AS VARCHAR), 6, '0') || '_' || CAST(key % 3 AS VARCHAR) || '.tif' AS path FROM tiles)"""


@query(_with(PLANS) + " SELECT label_id, path AS tilepath FROM boxes JOIN (SELECT DISTINCT path FROM files) ON ends_with(path, substr(Num_plan, 1, 6) || '_' || substr(Num_plan, 7) || '.tif') WHERE CAST(Num_box AS INTEGER) <= 35")
def box_files(spark, sf_dir):
    """The files of the plans of boxes with a number up to 35."""
    padded = lambda k: F.lpad((F.col(k) % 400).cast("string"), 6, "0")
    last = lambda k: (F.col(k) % 3).cast("string")
    boxes = fixtures.labels(spark, sf_dir).select("label_id", (F.col("label_id") % 50).cast("string").alias("Num_box"), F.concat(padded("label_id"), last("label_id")).alias("Num_plan"))
    lead = F.when(F.col("key") % 2 == 0, "/plans/a_").otherwise("/plans/")
    files = fixtures.tiles(spark, sf_dir).select(F.concat(lead, padded("key"), F.lit("_"), last("key"), F.lit(".tif")).alias("path"))
    return enrich.boxes_in_files(boxes, files).select("label_id", "tilepath")
