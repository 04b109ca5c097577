"""COCO documents from tiles and labels."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoloom.functions.geometry import Box, box_intersection, scaled_box, segment_area, segment_bbox, to_pixel
from geoloom.operators.spatial import spatial_join
from geoloom.storage import cut_lineage


def clip_boxes(tiles: DataFrame, tile_box: Box, labels: DataFrame, label_box: Box, scale: float = 1.0, cell: float = 128, on=()) -> DataFrame:
    """Pairs of tile and label with c_x0..c_y1, the label's part within the tile scaled about its centre; parts without area go."""
    pairs = spatial_join(tiles, tile_box, labels, label_box, cell, on)
    if scale != 1.0:
        sides = dict(zip(("_t0", "_t1", "_t2", "_t3"), scaled_box(tile_box, scale), strict=True))
        pairs, window = pairs.withColumns(sides), tuple(sides)
    else:
        window = tuple(tile_box)
    cut = dict(zip(("c_x0", "c_y0", "c_x1", "c_y1"), box_intersection(window, tuple(label_box)), strict=True))
    return pairs.withColumns(cut).drop("_t0", "_t1", "_t2", "_t3").where("c_x1 > c_x0 AND c_y1 > c_y0")


def annotations(clipped: DataFrame, tile_box: Box, width: int, height: int) -> DataFrame:
    """clipped with segmentation (one outline in pixels, without a closing point), bbox and area (that of the outline).

    A point outside the image, across or down, is an error.
    """
    w, h = F.lit(width), F.lit(height)
    corner = lambda x, y: to_pixel(F.col(x), F.col(y), tile_box, w, h)
    flat = [v for x, y in (("c_x0", "c_y0"), ("c_x1", "c_y0"), ("c_x1", "c_y1"), ("c_x0", "c_y1")) for v in corner(x, y)]
    out = clipped.withColumn("segment", F.array(*flat))
    across, down = F.filter("segment", lambda _, k: k % 2 == 0), F.filter("segment", lambda _, k: k % 2 == 1)
    inside = F.forall(across, lambda v: v.between(0, width)) & F.forall(down, lambda v: v.between(0, height))
    out = out.withColumn("segment", F.when(inside, F.col("segment")).otherwise(F.raise_error(F.lit("a label lies outside its tile"))))
    bbox = segment_bbox(F.col("segment"))
    return out.withColumn("bbox", bbox).withColumn("area", segment_area(F.col("segment"))).withColumn("segmentation", F.array("segment")).drop("segment")


def number(df: DataFrame, group: str, *order: str, name: str = "id") -> DataFrame:
    """df with positions from 1 in each group, as COCO ids.

    Rows are dealt out by ranges of group and order, numbered within a range, and moved on by what earlier ranges hold of
    the group, so no group has to fit one task. Rows equal in all of order take any turn.
    """
    ranged = cut_lineage(df.repartitionByRange(group, *order).withColumn("_part", F.spark_partition_id()))
    counts = ranged.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col(group).alias("_group"), F.col("_part").alias("_at"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    placed = ranged.join(counts, ranged[group].eqNullSafe(counts["_group"]) & (F.col("_part") == F.col("_at")))
    turn = F.row_number().over(Window.partitionBy("_part", group).orderBy(*order))
    return placed.withColumn(name, (F.col("_before") + turn).cast("int")).drop("_part", "_group", "_at", "_before")


def polygon_annotations(clipped: DataFrame, ring: str, tile_box: Box, width: int, height: int, *by: str) -> DataFrame:
    """One annotation for each value of by from the parts of a polygon in a tile, as shapes.clip_polygons() gives them.

    segmentation holds an outline in pixels for each part, without its closing point, by part; bbox bounds them all and
    area is their sum. A point outside the image is an error. tile_box must be the same in all parts of a value of by.
    """
    pixel = lambda p: to_pixel(p["x"], p["y"], tile_box, F.lit(width), F.lit(height))
    open_ring = F.slice(ring, F.lit(1), F.size(ring) - 1)
    flat = F.flatten(F.transform(open_ring, lambda p: F.array(*pixel(p))))
    across, down = F.filter("segment", lambda _, k: k % 2 == 0), F.filter("segment", lambda _, k: k % 2 == 1)
    inside = F.forall(across, lambda v: v.between(0, width)) & F.forall(down, lambda v: v.between(0, height))
    each = clipped.withColumn("segment", flat)
    each = each.withColumn("segment", F.when(inside, F.col("segment")).otherwise(F.raise_error(F.lit("a label lies outside its tile"))))
    found = each.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("part", "segment"))).alias("s"), F.sum(segment_area(F.col("segment"))).alias("area"))
    found = found.withColumn("segmentation", F.transform("s", lambda x: x["segment"])).drop("s")
    return found.withColumn("bbox", segment_bbox(F.flatten("segmentation")))


def info_block(year: int, version: str, description: str, contributor: str, url: str, created: str | None = None) -> dict:
    """The head of a document; created is an ISO date, today's without one."""
    return {"year": year, "version": version, "description": description, "contributor": contributor, "url": url, "date_created": created or date.today().isoformat()}


def fragments(images: DataFrame, notes: DataFrame, categories: DataFrame, info: dict, license_name: str, license_url: str) -> DataFrame:
    """(dataset, section, place, line): the lines of each dataset's COCO document, in order of section and place.

    Columns are as in documents(); images may also have date_captured. An image and an annotation take a line each, so no value grows with a dataset.
    """
    if not license_name:
        raise ValueError("the license of the images has no name")
    spark = images.sparkSession
    dated = ["date_captured"] if "date_captured" in images.columns else []
    image = F.to_json(F.struct("id", "width", "height", "file_name", "year", *dated, F.lit(1).alias("license")))
    note = F.to_json(F.struct("id", "image_id", "category_id", "segmentation", F.lit(0).alias("iscrowd"), "area", "bbox"))
    comma = F.when(F.col("id") > 1, ",").otherwise("")
    line = lambda df, section, text: df.select("dataset", F.lit(section).alias("section"), F.col("id").cast("long").alias("place"), F.concat(comma, text).alias("line"))
    kinds = [r.asDict() for r in categories.select("id", "name", "supercategory").orderBy("id").collect()]  # few by nature
    own = {k: v for k, v in info.items() if k != "description"}
    after = json.dumps([{"id": 1, "name": license_name, "url": license_url}]), json.dumps(kinds, ensure_ascii=False)
    said = F.concat(F.lit(f"{info.get('description', '')} - "), "dataset", F.lit(" dataset"))
    head = F.concat(F.lit('{"info":'), F.to_json(F.struct(*(F.lit(v).alias(k) for k, v in own.items()), said.alias("description"))), F.lit(',"images":['))
    names = spark.createDataFrame([(0, None), (2, '],"annotations":['), (4, f'],"licenses":{after[0]},"categories":{after[1]}}}')], "section int, text string")
    fixed = images.select("dataset").distinct().join(F.broadcast(names), F.lit(True)).select("dataset", "section", F.lit(0).cast("long").alias("place"), F.coalesce("text", head).alias("line"))  # three rows
    return fixed.unionByName(line(images, 1, image)).unionByName(line(notes.join(images.select("dataset").distinct(), "dataset", "left_semi"), 3, note))


def write_documents(lines: DataFrame, path: str) -> None:
    """A folder dataset=<name> for each dataset, whose files, by their names, are together its document.

    Lines of fragments() are dealt to tasks by ranges of their order, so many tasks write one document.
    """
    ranged = lines.repartitionByRange("dataset", "section", "place").sortWithinPartitions("dataset", "section", "place")
    ranged.select("dataset", "line").write.partitionBy("dataset").text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(dataset, image, annotation): the images and annotations of documents in lines, each row has one of the two."""
    image = "id int, width int, height int, file_name string, year int, license int"
    note = "id int, image_id int, category_id int, segmentation array<array<double>>, iscrowd int, area double, bbox array<double>"
    lines = spark.read.text(path).select("dataset", F.regexp_replace("value", "^,", "").alias("line")).where(F.col("line").startswith('{"id":'))
    pictured = F.col("line").contains('"file_name":') & ~F.col("line").contains('"segmentation":')
    return lines.select("dataset", F.when(pictured, F.from_json("line", image)).alias("image"), F.when(~pictured, F.from_json("line", note)).alias("annotation"))


def number_of_classes(spark: SparkSession, path: str) -> int:
    """How many categories the documents in lines have; none is an error. Their last lines hold them."""
    kinds = F.from_json(F.regexp_extract("value", r'"categories":(\[.*\])\}$', 1), "array<struct<id:int>>")
    found = spark.read.text(path).where(F.col("value").startswith('],"licenses":')).select(F.size(kinds).alias("n")).limit(1).collect()
    if not found or found[0].n < 1:
        raise ValueError(f"no class in {path}")
    return found[0].n


def documents(images: DataFrame, notes: DataFrame, categories: DataFrame, info: dict, license_name: str, license_url: str) -> DataFrame:
    """(dataset, document): a COCO document in JSON for each dataset.

    images: dataset, id, width, height, file_name, year; notes: dataset, id, image_id, category_id, segmentation,
    bbox, area. A document is one value by its format. A license needs a name.
    """
    if not license_name:
        raise ValueError("the license of the images has no name")
    image = F.struct("id", "width", "height", "file_name", "year", F.lit(1).alias("license"))
    note = F.struct("id", "image_id", "category_id", "segmentation", F.lit(0).alias("iscrowd"), "area", "bbox")
    pictures = images.groupBy("dataset").agg(F.sort_array(F.collect_list(image)).alias("images"))
    found = notes.groupBy("dataset").agg(F.array_sort(F.collect_list(note), lambda a, b: a["id"].cast("int") - b["id"].cast("int")).alias("annotations"))
    kinds = categories.agg(F.sort_array(F.collect_list(F.struct("id", "name", "supercategory"))).alias("categories"))
    head = F.struct(*(F.lit(v).alias(k) for k, v in info.items() if k != "description"), F.concat(F.lit(f"{info.get('description', '')} - "), "dataset", F.lit(" dataset")).alias("description"))
    licenses = F.array(F.struct(F.lit(1).alias("id"), F.lit(license_name).alias("name"), F.lit(license_url).alias("url")))
    joined = pictures.join(found, "dataset", "left").join(F.broadcast(kinds))  # one row
    body = F.struct(head.alias("info"), "images", F.coalesce("annotations", F.from_json(F.lit("[]"), found.schema["annotations"].dataType)).alias("annotations"), licenses.alias("licenses"), "categories")
    return joined.select("dataset", F.to_json(body).alias("document"))
