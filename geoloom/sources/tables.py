"""Readers and writers: GeoJSON, image catalogues, label columns, names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_geojson(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """A row for each feature of the files: the properties (a DDL schema) and ring, the outer outline of a polygon.

    A multi-polygon gives a row for each of its parts; features of other shapes have a null ring.
    """
    feature = f"features array<struct<properties:struct<{properties}>,geometry:struct<type:string,coordinates:string>>>"
    rows = spark.read.schema(feature).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    rings = "array<array<array<double>>>"
    parts = F.when(kind == "MultiPolygon", F.from_json(text, f"array<{rings}>")).when(kind == "Polygon", F.array(F.from_json(text, rings)))
    ring = F.transform(F.get("part", F.lit(0)), lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    return rows.select("f.properties", F.explode_outer(parts).alias("part")).select("properties.*", ring.alias("ring"))


def to_geojson(df: DataFrame, ring: str = "ring") -> DataFrame:
    """(value): a GeoJSON feature a row, for line-delimited files through write.text."""
    outline = F.transform(F.col(ring), lambda p: F.array(p["x"], p["y"]))
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(outline).alias("coordinates"))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*(c for c in df.columns if c != ring)).alias("properties"), shape.alias("geometry"))).alias("value"))


def normalise_categories(labels: DataFrame) -> DataFrame:
    """CATEGORY and SUPERCATEGORY from either spelling; a missing supercategory is foo, a missing category an error."""
    for name in ("category", "supercategory"):
        if name in labels.columns and name.upper() not in labels.columns:
            labels = labels.withColumnRenamed(name, name.upper())
    if "CATEGORY" not in labels.columns:
        raise ValueError("labels need a column CATEGORY or category")
    return labels if "SUPERCATEGORY" in labels.columns else labels.withColumn("SUPERCATEGORY", F.lit("foo"))


def label_table(spark: SparkSession, labels: DataFrame | None) -> DataFrame:
    """Labels with categories normalised and year as a whole year_label; None is an empty table."""
    if labels is None:
        return spark.createDataFrame([], "CATEGORY string, SUPERCATEGORY string")
    named = normalise_categories(labels)
    return named.withColumn("year_label", F.col("year").cast("int")).drop("year") if "year" in named.columns else named


METADATA = "width int, height int, year int, extent struct<xmin:double,ymin:double,xmax:double,ymax:double,spatialReference:struct<latestWkid:string>>"


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """A row for each image's JSON map {image: metadata}."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.explode(F.from_json("value", f"map<string,struct<{', '.join(f.replace(' ', ':', 1) for f in METADATA.split(', '))}>>"))).select(F.col("key").alias("img_file"), "value.*")


def read_image_metadata(spark: SparkSession, path: str) -> DataFrame:
    """A row for each file of one image's metadata; img_file is the file's path with tif for every json in its name."""
    found = spark.read.schema(METADATA).option("multiLine", True).json(path)
    name, file = F.regexp_extract(F.col("_metadata.file_path"), "[^/]*$", 0), F.col("_metadata.file_path")
    folder = F.substring(file, F.lit(1), F.length(file) - F.length(name))
    return found.select(F.concat(folder, F.replace(name, F.lit("json"), F.lit("tif"))).alias("img_file"), *found.columns)


def missing(tasks: DataFrame, catalogue: DataFrame, key: str = "img_file") -> DataFrame:
    """The tasks whose target isn't in the catalogue: what is left to fetch, or what a complete set lacks."""
    return tasks.join(catalogue.select(key), key, "left_anti")


def upsert_names(known: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """known and those rows of new whose key it lacks."""
    return known.unionByName(new.join(known.select(key), key, "left_anti"), allowMissingColumns=True)


def add_names(known: DataFrame, new: DataFrame, key: str, name: str) -> DataFrame:
    """A table of names after another step: new's rows that known lacks if it has the step's column name already, else that
    column joined by key; a row that new lacks has null."""
    if name in known.columns:
        return upsert_names(known, new, name)
    return known.join(new.select(key, name), key, "left")


def fetch(tasks: DataFrame, get, schema: str) -> DataFrame:
    """What get(row) returns for each task, fetched in the tasks; None counts as failed and gives no row."""
    import pandas as pd

    def run(batches):
        for batch in batches:
            found = [r for r in map(get, batch.to_dict("records")) if r is not None]
            if found:
                yield pd.DataFrame(found)

    return tasks.mapInPandas(run, schema)


def assert_unique(df: DataFrame, key: str) -> DataFrame:
    """df itself, if no key comes twice or is null; else an error."""
    if df.where(F.col(key).isNull()).limit(1).count() or df.groupBy(key).count().where("count > 1").limit(1).count():
        raise ValueError(f"{key} must be present and unique")
    return df
