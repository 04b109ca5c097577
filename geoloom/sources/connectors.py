"""Requests to image services, and sinks: what a task asks for, as columns; metrics, catalogues and COCO files as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.config import MULTI, check_tile_year
from geoloom.functions.geometry import Box
from geoloom.functions.names import fill_address, image_format, tile_file
from geoloom.sources.tiff import tiff_info


def _text(box: Box) -> Column:
    return F.concat_ws(",", *(F.col(c).cast("double").cast("string") for c in box))


def wms_request(box: Box, layers: str, srs: str, width: int, height: int, image: str = "image/tiff") -> Column:
    """The parameters of a GetMap request (version 1.1.1) for a box."""
    fixed = {"SERVICE": "WMS", "VERSION": "1.1.1", "REQUEST": "GetMap", "LAYERS": layers, "STYLES": "", "SRS": srs, "WIDTH": str(width), "HEIGHT": str(height), "FORMAT": image, "TRANSPARENT": "true"}
    return F.map_concat(F.create_map(*(F.lit(v) for kv in fixed.items() for v in kv)), F.create_map(F.lit("BBOX"), _text(box)))


def export_request(box: Box, epsg: int, width: int, height: int, image: str = "tiff") -> Column:
    """The parameters of an image server's export request for a box."""
    fixed = {"bboxSR": str(epsg), "imageSR": str(epsg), "size": f"{width},{height}", "format": image, "f": "image"}
    return F.map_concat(F.create_map(F.lit("bbox"), _text(box)), F.create_map(*(F.lit(v) for kv in fixed.items() for v in kv)))


def xyz_tasks(tiles: DataFrame, template: str, year: int | str | None = None) -> DataFrame:
    """tiles (x, y, z, and year_tile for several years) with url and img_file, as the source's addresses are made.

    The image's format is the one that the address names; an address without one is an error.
    """
    used = check_tile_year("XYZ", year, tiles.columns)
    when = F.col("year_tile") if used == MULTI else F.lit(used)
    values = {c: F.col(c) for c in ("x", "y", "z")} | ({"year": when} if used is not None else {})
    url = fill_address(template, **values)
    suffix = F.coalesce(image_format(url), F.raise_error(F.concat(F.lit("no image format in "), url)))
    return tiles.withColumn("url", url).withColumn("img_file", tile_file(F.col("x"), F.col("y"), F.col("z"), suffix, when if used == MULTI else None))


def folder_files(tasks: DataFrame, files: DataFrame, name: str = "img_file") -> DataFrame:
    """tasks with path, that of the file of this base name; a task without a file has null, of several the first path stays."""
    found = files.groupBy(F.substring_index("path", "/", -1).alias("_base")).agg(F.min("path").alias("path"))
    return tasks.withColumn("_base", F.substring_index(name, "/", -1)).join(found, "_base", "left").drop("_base")


def folder_metadata(found: DataFrame, box: Box, name: str = "img_file", year: str | None = None) -> DataFrame:
    """(name, width, height, year, extent) of the files that folder_files() found: sizes and EPSG code as the files' headers
    say, the extent as the task's box says. Tasks without a file have no row; a name that doesn't end in .tif is an error."""
    info = tiff_info(found.where("path IS NOT NULL").select("path").distinct()).select(F.col("path").alias("_path"), "width", "height", "epsg")
    extent = F.struct(*(F.col(c).cast("double").alias(n) for c, n in zip(box, ("xmin", "ymin", "xmax", "ymax"), strict=True)), F.struct(F.col("epsg").cast("string").alias("latestWkid")).alias("spatialReference"))
    when = F.col(year).cast("int") if year else F.lit(None).cast("int")
    checked = F.when(F.endswith(F.col(name), F.lit(".tif")), F.col(name)).otherwise(F.raise_error(F.concat(F.col(name), F.lit(" must end in .tif"))))
    tasks = found.select(F.col("path").alias("_path"), checked.alias(name), when.alias("year"), *box)
    return tasks.join(info, "_path").select(name, "width", "height", "year", extent.alias("extent"))


def assert_complete(images: DataFrame, metadata: DataFrame, name: str = "img_file") -> DataFrame:
    """images itself, if each has metadata beside it and no metadata lacks its image; else an error. Names end in .tif and .json."""
    stem = lambda df: df.select(F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"))
    odd = stem(images).exceptAll(stem(metadata)).unionByName(stem(metadata).exceptAll(stem(images))).limit(1).collect()
    if odd:
        raise ValueError(f"{odd[0].stem} has no image or no metadata")
    return images


def write_csv(table: DataFrame, path: str) -> None:
    """A table of metrics as CSV with a header; such tables are small, so they are one file."""
    table.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_catalogue(images: DataFrame, path: str, name: str = "img_file") -> None:
    """Metadata of images as lines of JSON, a file a task; the image's name comes first."""
    images.select(name, *(c for c in images.columns if c != name)).write.mode("overwrite").json(path)


def read_catalogue(spark: SparkSession, path: str, metadata: str, name: str = "img_file") -> DataFrame:
    """What write_catalogue() wrote: the image's name and the columns of metadata, a DDL schema; missing ones are null."""
    return spark.read.schema(f"{name} string, {metadata}").json(path)


def write_coco(documents: DataFrame, path: str) -> None:
    """(dataset, document) as one text file a dataset below dataset=<name>."""
    documents.select("dataset", F.col("document").alias("value")).repartition("dataset").write.mode("overwrite").partitionBy("dataset").text(path)
