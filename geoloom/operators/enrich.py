"""Names, classes and metadata joined to rows, and small rules on columns.

Joins to dimensions neither lose nor repeat a row: a dimension's key must be unique (checked), and a row without a
partner stays (left) or is an error (whole=True).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions.geometry import Box, box_area
from geoloom.operators.assess import FN
from geoloom.operators.coco import number
from geoloom.sources.tables import assert_unique

# The longest perimeter of a plan's outline for each scale; longer ones are of the last scale.
PERIMETERS = ((2575, 500), (4450, 1000), (9680, 2000))
LAST_SCALE = 4000
#: Names for the side of a pair that is not there.
BACKGROUND, MISSED = "background", "missed labels"


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    """(label_class, CATEGORY, SUPERCATEGORY) of a JSON map {name: {id, name, supercategory}}."""
    kind = "map<string,struct<id:int,name:string,supercategory:string>>"
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", kind)).alias("k", "c"))
    return rows.select(F.col("c.id").alias("label_class"), F.col("c.name").alias("CATEGORY"), F.col("c.supercategory").alias("SUPERCATEGORY"))


def look_up(df: DataFrame, dim: DataFrame, key: str, whole: bool = False) -> DataFrame:
    """df with the columns that dim has for key. A key that comes twice or is null in dim is an error; so, with whole, is a
    row of df whose key dim lacks. Null keys of df find nothing."""
    found = df.join(assert_unique(dim, key).withColumn("_met", F.lit(True)), key, "left")
    if whole:
        lost = F.raise_error(F.concat(F.lit(f"no partner for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
        found = found.withColumn("_met", F.when(F.col("_met"), True).otherwise(lost)).where("_met")
    return found.drop("_met")


def label_classes(labels: DataFrame, categories: DataFrame) -> DataFrame:
    """labels with label_class by CATEGORY as text; a label of a name that two supercategories share comes for each."""
    names = categories.select(F.col("CATEGORY").cast("string").alias("CATEGORY"), "label_class")
    return labels.withColumn("CATEGORY", F.col("CATEGORY").cast("string")).join(F.broadcast(names), "CATEGORY", "left")  # one row a class


def class_names(tagged: DataFrame, categories: DataFrame) -> DataFrame:
    """tagged with CATEGORY of its label_class and det_category of its det_class (from 0); null classes have null names,
    a class that categories lacks is an error."""
    names = assert_unique(categories.select("label_class", "CATEGORY"), "label_class")
    out = tagged
    for key, name in ((F.col("label_class"), "CATEGORY"), (F.col("det_class") + 1, "det_category")):
        own = F.broadcast(names.select(F.col("label_class").alias("_class"), F.col("CATEGORY").alias(name)))  # one row a class
        out = out.join(own, key == F.col("_class"), "left")
        lost = key.isNotNull() & F.col("_class").isNull()
        out = out.withColumn(name, F.when(lost, F.raise_error(F.concat(F.lit("unknown class "), key.cast("string")))).otherwise(F.col(name))).drop("_class")
    return out


def confusion_table(tagged: DataFrame, names: list[str], truth: str = "CATEGORY", found: str = "det_category") -> DataFrame:
    """(dataset, true class, a column for each name and missed labels): counts of a confusion matrix, 0 where there is none.

    Rows without a label are of the background; labels without a detection are missed labels. Detections and labels that
    were rejected for their size count as such rows too.
    """
    sides = tagged.select("dataset", F.coalesce(truth, F.lit(BACKGROUND)).alias("true_class"), F.coalesce(found, F.lit(MISSED)).alias("found"))
    return sides.groupBy("dataset", "true_class").pivot("found", [*names, MISSED]).count().na.fill(0)


def stack_detections(sets: dict[str, DataFrame], key: str, box: Box) -> DataFrame:
    """The rows of all sets by name, with dataset, area and det_id from 0 by the sets' order and key; year_det whole.

    A column that a set lacks is null there.
    """
    out = None
    for turn, (name, rows) in enumerate(sets.items()):
        one = rows.drop("dataset", "area", "det_id").withColumns({"dataset": F.lit(name), "_turn": F.lit(turn), "_all": F.lit(0)})
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    out = number(out.withColumn("area", box_area(box)), "_all", "_turn", key, name="det_id").withColumn("det_id", F.col("det_id") - 1).drop("_turn", "_all")
    return out.withColumn("year_det", F.col("year_det").cast("int")) if "year_det" in out.columns else out


def drop_missed(tagged: DataFrame) -> DataFrame:
    """The rows that a detection stands behind; a table without tags as it is."""
    return tagged.where(F.col("tag") != FN) if "tag" in tagged.columns else tagged


def drop_incomplete(df: DataFrame) -> DataFrame:
    """The rows without any null."""
    return df.na.drop("any")


def coded_category(code: Column, color: Column) -> Column:
    """A code as a whole number with its color behind; undetermined without a color."""
    return F.when(color.isNotNull() & (color != ""), F.concat(code.cast("int").cast("string"), color)).otherwise("undetermined")


def box_file(number: Column, suffix: str) -> Column:
    """The end of the file name of a box: an underscore after the sixth character of its number."""
    return F.concat(F.substring(number, 1, 6), F.lit("_"), F.substring(number, 7, 1 << 20), F.lit(suffix))


def boxes_in_files(boxes: DataFrame, files: DataFrame, suffix: str = ".tif", last: int = 35, number: str = "Num_box", plan: str = "Num_plan", path: str = "path") -> DataFrame:
    """boxes up to number last with tilepath, a row for each file whose path ends in the box_file() of the box's plan.

    A box without such a file has no row, and a number that isn't whole is none. Paths are matched by their possible ends,
    one for each underscore in the name, so the join is by equality.
    """
    chosen = boxes.where(F.col(number).try_cast("int") <= last).withColumn("_end", box_file(F.col(plan), suffix))
    named = files.where(F.endswith(F.col(path), F.lit(suffix))).select(F.col(path).alias("tilepath")).distinct()
    size, stem = F.length("tilepath"), F.length("tilepath") - len(suffix)
    places = F.filter(F.sequence(F.lit(1), size), lambda k: (F.substring("tilepath", k, F.lit(1)) == "_") & (k <= stem))
    # Six characters stand before the underscore; fewer only where a short plan ends in it.
    ends = F.transform(places, lambda k: F.when(k < stem, F.array(k - 6)).otherwise(F.sequence(k - 6, k)))
    starts = F.filter(F.flatten(ends), lambda k: k >= 1)
    tails = named.select("tilepath", F.explode(F.array_distinct(F.transform(starts, lambda k: F.substring("tilepath", k, size)))).alias("_end"))
    return chosen.join(tails, "_end").drop("_end")


def perimeter_scale(perimeter: Column) -> Column:
    """The scale of a plan by its perimeter; null for null."""
    out = F.when(perimeter.isNull(), F.lit(None).cast("int"))
    for longest, scale in PERIMETERS:
        out = out.when(perimeter <= longest, scale)
    return out.otherwise(LAST_SCALE)


def threshold_label(threshold: Column) -> Column:
    """A threshold of hundredths in file names: 5 is 0dot05."""
    return F.regexp_replace(F.regexp_replace(F.format_string("%.2f", threshold / 100.0), r"0$", ""), r"\.", "dot")
