"""Detections, labels, tiles and points with whole-number coordinates, derived from the driver's tables; and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CLASSES = range(1, 6)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dataset(key: str) -> Column:
    return F.element_at(F.array(F.lit("trn"), F.lit("val"), F.lit("tst")), (F.col(key) % 3 + 1).cast("int"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey").cast("long")
    out = _table(spark, sf_dir, "orders").select(
        k.alias("label_id"), (k * 37 % 3989).alias("l_x0"), (k * 91 % 4999).alias("l_y0"), (8 + k % 23).alias("w"), (8 + k % 17).alias("h"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("label_class"), F.col("o_orderpriority").alias("category"), F.year("o_orderdate").alias("year_label"),
    )
    return out.withColumn("l_x1", F.col("l_x0") + F.col("w")).withColumn("l_y1", F.col("l_y0") + F.col("h")).withColumn("dataset", _dataset("label_id"))


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("det_id")
    events = _table(spark, sf_dir, "events").select(F.col("event_id").cast("long").alias("det_id"), F.col("event_type").alias("image"))
    events = events.withColumn("k", F.when(k % 5 == 0, F.greatest(k - 1, F.lit(0))).otherwise(k))
    found = events.join(labels(spark, sf_dir).withColumnRenamed("dataset", "_d"), F.col("k") == F.col("label_id"))
    x0, y0 = F.col("l_x0") + k * 7919 % 21 - 10, F.col("l_y0") + k * 104729 % 17 - 8
    det_class = F.when(k % 7 == 0, F.col("label_class") % 5).otherwise(F.col("label_class") - 1)
    return found.select(
        "det_id", x0.alias("d_x0"), y0.alias("d_y0"), (x0 + F.col("w")).alias("d_x1"), (y0 + F.col("h")).alias("d_y1"), det_class.alias("det_class"),
        (k * 31 % 97 / F.lit(97.0)).alias("score"), "image", (F.col("year_label") + F.when(k % 11 == 0, 1).otherwise(0)).alias("year_det"), _dataset("label_id").alias("dataset"),
    )


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey").cast("long")
    out = _table(spark, sf_dir, "part").select(p.alias("key"), (p % 40).alias("tx"), F.expr("CAST(p_partkey AS BIGINT) div 40").alias("ty"))
    return out.select("key", "tx", "ty", F.format_string("(%d, %d, 18)", "tx", "ty").alias("id"), (F.col("tx") * 100).alias("t_x0"), (F.col("ty") * 100).alias("t_y0"), (F.col("tx") * 100 + 100).alias("t_x1"), (F.col("ty") * 100 + 100).alias("t_y1"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id").cast("long")
    return _table(spark, sf_dir, "events").select(e.alias("event_id"), (5.9 + e % 4600 / F.lit(1000.0)).alias("lon"), (45.8 + e * 17 % 2000 / F.lit(1000.0)).alias("lat"))


def classes(spark: SparkSession) -> DataFrame:
    return spark.range(CLASSES.start, CLASSES.stop).select(F.col("id").cast("int").alias("class"))


SQL = """
labels AS (SELECT *, l_x0 + w AS l_x1, l_y0 + h AS l_y1, ['trn', 'val', 'tst'][label_id % 3 + 1] AS dataset FROM (SELECT CAST(o_orderkey AS BIGINT) AS label_id,
  CAST(o_orderkey AS BIGINT) * 37 % 3989 AS l_x0, CAST(o_orderkey AS BIGINT) * 91 % 4999 AS l_y0, 8 + CAST(o_orderkey AS BIGINT) % 23 AS w, 8 + CAST(o_orderkey AS BIGINT) % 17 AS h,
  CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS label_class, o_orderpriority AS category, CAST(year(o_orderdate) AS INTEGER) AS year_label FROM orders)),
dets AS (SELECT *, d_x0 + w AS d_x1, d_y0 + h AS d_y1 FROM (SELECT CAST(event_id AS BIGINT) AS det_id, l_x0 + CAST(event_id AS BIGINT) * 7919 % 21 - 10 AS d_x0, l_y0 + CAST(event_id AS BIGINT) * 104729 % 17 - 8 AS d_y0, w, h,
  CAST(CASE WHEN event_id % 7 = 0 THEN label_class % 5 ELSE label_class - 1 END AS INTEGER) AS det_class, (CAST(event_id AS BIGINT) * 31 % 97) / CAST(97 AS DOUBLE) AS score, event_type AS image,
  CAST(year_label + CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS INTEGER) AS year_det, dataset
  FROM events JOIN labels ON label_id = CASE WHEN event_id % 5 = 0 THEN greatest(CAST(event_id AS BIGINT) - 1, 0) ELSE event_id END)),
tiles AS (SELECT *, tx * 100 AS t_x0, ty * 100 AS t_y0, tx * 100 + 100 AS t_x1, ty * 100 + 100 AS t_y1, '(' || tx || ', ' || ty || ', 18)' AS id
  FROM (SELECT CAST(p_partkey AS BIGINT) AS key, CAST(p_partkey AS BIGINT) % 40 AS tx, CAST(p_partkey AS BIGINT) // 40 AS ty FROM part)),
pairs AS (SELECT d.*, l.dataset AS l_dataset, label_id, label_class, category, year_label, l_x0, l_y0, l_x1, l_y1,
  greatest(least(d_x1, l_x1) - greatest(d_x0, l_x0), 0) * greatest(least(d_y1, l_y1) - greatest(d_y0, l_y0), 0) AS shared
  FROM dets d JOIN labels l ON d_x0 <= l_x1 AND l_x0 <= d_x1 AND d_y0 <= l_y1 AND l_y0 <= d_y1),
ious AS (SELECT *, shared / CAST((d_x1 - d_x0) * (d_y1 - d_y0) + (l_x1 - l_x0) * (l_y1 - l_y0) - shared AS DOUBLE) AS iou FROM pairs)"""
