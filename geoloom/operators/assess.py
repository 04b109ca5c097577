"""Matching of detections to labels, and the metrics of it.

Detections carry det_id, score, det_class (from 0), dataset, year_det and a box d_x0..d_y1; labels carry label_id,
label_class (from 1), dataset, year_label and a box l_x0..l_y1. Ties go to the lowest id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.functions.geometry import box_iou
from geoloom.operators.spatial import meeting_keys, similar_join, spatial_join
from geoloom.storage import stored

DET_BOX = ("d_x0", "d_y0", "d_x1", "d_y1")
LABEL_BOX = ("l_x0", "l_y0", "l_x1", "l_y1")
IOU = 0.25
#: IoU that best_matches() looks for first.
STEPS = (0.7, 0.5)
#: Cells for boxes that lie close together: smaller ones cost more rows and fewer tested pairs.
CLOSE = 40
TP, FP, FN, MISMATCH, SMALL = "TP", "FP", "FN", "MISMATCHED CLASSES", "SMALL POLY"
#: Thresholds of a sweep in hundredths.
SWEEP = range(5, 100, 5)
METHODS = ("macro-average", "macro-weighted-average", "micro-average")


def iou_pairs(dets: DataFrame, labels: DataFrame, strict_year: bool = False, by_dataset: bool = False) -> DataFrame:
    """(det_id, score, det_class, year_det, label_id, label_class, year_label, iou) of all pairs that intersect,
    of equal years with strict_year and of one dataset with by_dataset."""
    on = [("year_det", "year_label")] if strict_year else []
    on += [("dataset", "l_dataset")] if by_dataset else []
    d = dets.select("det_id", "score", "det_class", "year_det", "dataset", *DET_BOX)
    found = spatial_join(d, DET_BOX, _known(labels), LABEL_BOX, on=on)
    return found.withColumn("iou", box_iou(DET_BOX, LABEL_BOX)).drop(*DET_BOX, *LABEL_BOX, "dataset", "l_dataset")


def best_labels(pairs: DataFrame) -> DataFrame:
    """Each detection's label of the highest IoU. It doesn't depend on a score threshold."""
    best = F.max(F.struct("iou", (-F.col("label_id")).alias("low"), "label_class")).alias("b")
    found = pairs.groupBy("det_id", "score", "det_class", "year_det").agg(best)
    return found.select("det_id", "score", "det_class", "year_det", (-F.col("b.low")).alias("label_id"), "b.label_class", "b.iou")


def _known(labels: DataFrame) -> DataFrame:
    return labels.select("label_id", "label_class", "year_label", F.col("dataset").alias("l_dataset"), *LABEL_BOX)


def best_matches(dets: DataFrame, labels: DataFrame, iou: float = IOU, strict_year: bool = False, by_dataset: bool = False) -> DataFrame:
    """best_labels() of iou_pairs() where the IoU is iou or more, without all pairs.

    Labels of a high IoU are looked for close by, and further away only for detections that have none there. So where
    boxes lie close together, and pairs grow with the square of the table, most detections see few labels.
    """
    on = [("year_det", "year_label")] if strict_year else []
    on += [("dataset", "l_dataset")] if by_dataset else []
    left, known, found = dets.select("det_id", "score", "det_class", "year_det", "dataset", *DET_BOX), _known(labels), None
    for step in (*(s for s in STEPS if s > iou), iou):
        pairs = similar_join(left, DET_BOX, known, LABEL_BOX, step, CLOSE, on).withColumn("iou", box_iou(DET_BOX, LABEL_BOX)).where(F.col("iou") >= step)
        best = stored(best_labels(pairs))
        found = best if found is None else found.unionByName(best)
        left = left.join(best.select("det_id"), "det_id", "left_anti")
    return found


def best_detections(best: DataFrame, *keys: str, iou: float = IOU) -> DataFrame:
    """Each label's detection of the highest IoU among those that chose it with iou at least; that IoU is rounded to 3 digits."""
    pick = F.max(F.struct("iou", (-F.col("det_id")).alias("low"), "det_class")).alias("b")
    found = best.where(F.col("iou") >= iou).groupBy("label_id", "label_class", *keys).agg(pick)
    return found.select("label_id", "label_class", *keys, (-F.col("b.low")).alias("det_id"), "b.det_class", F.round("b.iou", 3).alias("iou"))


def is_hit() -> Column:
    return F.col("label_class") == F.col("det_class") + 1


def fractional_sets(dets: DataFrame, labels: DataFrame, iou: float = IOU, area: float | None = None, year: str | None = None, by_dataset: bool = False, best: DataFrame | None = None) -> DataFrame:
    """(tag, det_id, label_id, dataset, det_class, label_class, score, iou): every detection and unmatched label once.

    by_dataset keeps datasets apart. year: None ignores years; "compat" compares them after the spatial join, so that rows which meet only other years
    get no tag; "strict" joins on them. area rejects smaller boxes as SMALL POLY; None and 0 don't, and nor does a
    table without labels. The last two are checked without a collect: an empty label table just matches nothing. best
    is what best_matches() gives for the same tables and settings, if it is known; it is left aside if area rejects boxes.
    """
    dets, small = stored(dets.select("det_id", "score", "det_class", "year_det", "dataset", *DET_BOX)), None  # read in each step
    if area:
        size = lambda b: (F.col(b[2]) - F.col(b[0])) * (F.col(b[3]) - F.col(b[1])) < area
        some = labels.limit(1).select(F.lit(True).alias("some"))
        rejected = dets.where(size(DET_BOX)).join(F.broadcast(some), how="inner").drop("some")
        small = _row(rejected, SMALL).unionByName(_row(labels.where(size(LABEL_BOX)), SMALL))
        dets, labels = dets.join(rejected.select("det_id"), "det_id", "left_anti"), labels.where(~size(LABEL_BOX))
    if best is None or area:
        best = best_matches(dets, labels, iou, year is not None, by_dataset)
    matched = stored(best_detections(best, *(["year_det"] if year else []), iou=iou))
    scores = dets.select("det_id", "score", "dataset")
    tagged = matched.join(scores, "det_id").withColumn("tag", F.when(is_hit(), TP).otherwise(MISMATCH))
    fp = dets.join(matched.select("det_id"), "det_id", "left_anti")
    fn = labels.join(matched.select("label_id"), "label_id", "left_anti")
    if year == "compat":
        known, on, same = _known(labels), [("year_det", "year_label")], [("dataset", "l_dataset")] if by_dataset else []
        fp = _without_lost(fp, DET_BOX, "det_id", known, LABEL_BOX, on, same)
        turned = lambda pairs: [(y, x) for x, y in pairs]
        fn = _without_lost(fn.withColumn("l_dataset", F.col("dataset")), LABEL_BOX, "label_id", dets, DET_BOX, turned(on), turned(same))
    columns = ["tag", "det_id", "label_id", "dataset", "det_class", "label_class", "score", "iou"]
    out = tagged.select(columns).unionByName(_row(fp, FP)).unionByName(_row(fn, FN))
    return out.unionByName(small) if small is not None else out


def _without_lost(rest: DataFrame, box: tuple[str, ...], key: str, others: DataFrame, other_box: tuple[str, ...], year: list, same: list) -> DataFrame:
    """rest without the boxes that meet others, but none of their year."""
    names = [key, *box, *(x for x, _ in (*year, *same))]
    others = others.select(*other_box, *(y for _, y in (*year, *same)))
    rest = stored(rest)
    other_year = rest.select(*names).join(meeting_keys(rest, box, others, other_box, key, on=[*year, *same]), key, "left_anti")
    return rest.join(meeting_keys(other_year, box, others, other_box, key, on=same), key, "left_anti")


def _row(df: DataFrame, tag: str) -> DataFrame:
    kinds = {"det_id": "long", "label_id": "long", "dataset": "string", "det_class": "int", "label_class": "int", "score": "double", "iou": "double"}
    of = lambda c, k: (F.col(c) if c in df.columns else F.lit(None)).cast(k).alias(c)
    return df.select(F.lit(tag).alias("tag"), *(of(c, k) for c, k in kinds.items()))


def class_counts(tagged: DataFrame, classes: DataFrame, *keys: str) -> DataFrame:
    """(keys, class, TP_k, FP_k, FN_k, precision_k, recall_k) for every class (from 1) of the small table classes."""
    det, label = F.col("det_class") + 1, F.col("label_class")
    hit, wrong = F.col("tag") == TP, F.col("tag") == MISMATCH
    sides = F.array(
        F.struct(label.cast("int").alias("class"), hit.cast("long").alias("tp"), F.lit(0).cast("long").alias("fp"), ((F.col("tag") == FN) | wrong).cast("long").alias("fn")),
        F.struct(det.cast("int").alias("class"), F.lit(0).cast("long").alias("tp"), ((F.col("tag") == FP) | wrong).cast("long").alias("fp"), F.lit(0).cast("long").alias("fn")),
    )
    counted = tagged.where(F.col("tag") != SMALL).select(*keys, F.inline(sides)).where("class IS NOT NULL")
    counted = counted.groupBy(*keys, "class").agg(*(F.sum(c).alias(c) for c in ("tp", "fp", "fn")))
    return with_classes(counted, classes, *keys)


def with_classes(counted: DataFrame, classes: DataFrame, *keys: str) -> DataFrame:
    grid = F.broadcast(classes.select("class"))  # one row a class
    every = counted.select(*keys).distinct().join(grid) if keys else grid
    full = every.join(counted, [*keys, "class"], "left").na.fill(0, ["tp", "fp", "fn"])
    ratio = lambda c: F.when(F.col("tp") > 0, F.col("tp") / (F.col("tp") + F.col(c))).otherwise(0.0)
    return full.select(*keys, "class", *(F.col(c).alias(f"{c.upper()}_k") for c in ("tp", "fp", "fn")), ratio("fp").alias("precision_k"), ratio("fn").alias("recall_k"))


def metrics(by_class: DataFrame, *keys: str, method: str = "macro-average", corrected: bool = False) -> DataFrame:
    """(keys, TP_k, FP_k, FN_k, precision, recall, f1) by one of METHODS.

    The weighted average divides by the number of classes once more, unless corrected.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method}")
    added = lambda name: F.aggregate(F.transform(F.sort_array(F.col("rows")), lambda r: r[name]), F.lit(0.0), lambda s, v: s + v)
    weight = (F.col("TP_k") + F.col("FN_k")).cast("double")
    rows = F.collect_list(F.struct("class", F.col("precision_k").alias("p"), F.col("recall_k").alias("r"), (weight * F.col("precision_k")).alias("wp"), (weight * F.col("recall_k")).alias("wr")))
    sums = by_class.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("TP_k", "FP_k", "FN_k")), rows.alias("rows"))  # a list entry a class
    n, labels = F.size("rows"), (F.col("TP_k") + F.col("FN_k")).cast("double")
    if method == "micro-average":
        value = [F.when(F.col("TP_k") > 0, F.col("TP_k") / (F.col("TP_k") + F.col(c))).otherwise(0.0) for c in ("FP_k", "FN_k")]
    elif method == "macro-average":
        value = [added(c) / n for c in ("p", "r")]
    else:
        value = [F.when(labels > 0, added(c) / labels / (F.lit(1) if corrected else n)).otherwise(0.0) for c in ("wp", "wr")]
    out = sums.select(*keys, "TP_k", "FP_k", "FN_k", value[0].alias("precision"), value[1].alias("recall"))
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))


def threshold_sweep(dets: DataFrame, labels: DataFrame, classes: DataFrame, iou: float = IOU, best: DataFrame | None = None) -> DataFrame:
    """(dataset, threshold, class, TP_k, ...) for all thresholds of SWEEP in hundredths, from one spatial join within datasets.

    A detection counts from its highest threshold down. So a label's best detection at a threshold is the best of those
    whose highest threshold is there or above: one row for each label and highest threshold, and a running maximum.
    The numbers of detections come from one count by their highest threshold. best is what best_matches() gives within
    datasets, if it is known.
    """
    spark = dets.sparkSession
    grid = spark.range(SWEEP.start, SWEEP.stop, SWEEP.step).select(F.col("id").cast("int").alias("threshold"))
    reached = lambda c: F.filter(F.sequence(F.lit(SWEEP.start), F.lit(SWEEP.stop - 1), F.lit(SWEEP.step)), lambda t: c >= t / F.lit(100.0))
    dets = stored(dets.select("det_id", "score", "det_class", "year_det", "dataset", *DET_BOX))  # read in each step
    best = best_matches(dets, labels, iou, by_dataset=True) if best is None else best
    best = best.withColumn("top", F.array_max(reached(F.col("score")))).where("top IS NOT NULL")
    pick = F.max(F.struct("iou", (-F.col("det_id")).alias("low"), "det_class"))
    steps = best.groupBy("label_id", "label_class", "top").agg(pick.alias("b"))  # a row for each threshold of a label at most
    falling = Window.partitionBy("label_id").orderBy(F.col("top").desc())
    steps = steps.withColumn("b", F.max("b").over(falling.rowsBetween(Window.unboundedPreceding, 0))).withColumn("below", F.coalesce(F.lead("top").over(falling), F.lit(0)))
    matched = steps.where(F.col("label_class") == F.col("b.det_class") + 1).join(labels.select("label_id", "dataset"), "label_id")
    matched = matched.groupBy("dataset", "label_class", "top", "below").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(grid), (F.col("threshold") <= F.col("top")) & (F.col("threshold") > F.col("below")))
    nothing = F.lit(0).cast("long")
    taken = matched.select("dataset", "threshold", F.col("label_class").cast("int").alias("class"), F.col("n").alias("tp"), nothing.alias("dets"), nothing.alias("labels"))
    top = dets.select("dataset", (F.col("det_class") + 1).cast("int").alias("class"), F.array_max(reached(F.col("score"))).alias("top"))
    top = top.groupBy("dataset", "class", "top").agg(F.count(F.lit(1)).alias("n"))
    seen = top.join(F.broadcast(grid), F.col("top") >= F.col("threshold")).select("dataset", "threshold", "class", nothing.alias("tp"), F.col("n").alias("dets"), nothing.alias("labels"))
    known = labels.groupBy("dataset", F.col("label_class").cast("int").alias("class")).agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(grid))  # 19 rows
    known = known.select("dataset", "threshold", "class", nothing.alias("tp"), nothing.alias("dets"), F.col("n").alias("labels"))
    counted = taken.unionByName(seen).unionByName(known).groupBy("dataset", "threshold", "class").agg(*(F.sum(c).alias(c) for c in ("tp", "dets", "labels")))
    counted = counted.select("dataset", "threshold", "class", "tp", (F.col("dets") - F.col("tp")).alias("fp"), (F.col("labels") - F.col("tp")).alias("fn"))
    return with_classes(counted, classes, "dataset", "threshold")


def best_threshold(swept: DataFrame, dataset: str = "val", method: str = "macro-average") -> DataFrame:
    """The lowest threshold of the highest F1 in one dataset."""
    found = metrics(swept.where(F.col("dataset") == dataset), "dataset", "threshold", method=method)
    return found.orderBy(F.col("f1").desc(), "threshold").limit(1).select("threshold", "f1")


def confusion_matrix(tagged: DataFrame) -> DataFrame:
    """(dataset, label_class, det_class, n), classes from 1, null for the background."""
    return tagged.groupBy("dataset", F.col("label_class").cast("int").alias("label_class"), (F.col("det_class") + 1).cast("int").alias("det_class")).agg(F.count(F.lit(1)).alias("n"))
