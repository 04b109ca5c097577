"""The jobs end to end: from settings and input tables to all tables that a job writes.

Each job takes the settings of geoloom.config and DataFrames as the readers of geoloom.sources give them, and returns a
dict of DataFrames by name, so that any sink can take them. Boxes are columns as in geoloom.operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom import config
from geoloom.operators import assess, coco, post, tilesets
from geoloom.sources import connectors
from geoloom.storage import stored

#: Labels are clipped by tiles scaled about their centre by this, so that neighbours don't share a rim.
CLIP_SCALE = 0.9999


def make_tilesets(settings: config.Tilesets, tiles: DataFrame, truth: DataFrame | None = None, others: DataFrame | None = None, false: DataFrame | None = None, key: str = "key") -> dict[str, DataFrame]:
    """tiles: those of the job with tile_kind and dataset; tasks: the images that they need, for tiled services.

    tiles have id, a whole-number key and TILE_BOX; truth, others and false positives LABEL_BOX and, truth, label_class. Without
    truth all tiles are in the set oth. A seed in the settings splits each kind by its own share; without one the split of
    ground truth comes from the seed of the best score.
    """
    config.check_tiles(tiles.select("id", *(["year_tile"] if "year_tile" in tiles.columns else [])))
    if truth is None:
        found = tilesets.without_ground_truth(tiles).withColumn("tile_kind", F.lit("oth"))
    else:
        ids = lambda df: None if df is None else tilesets.met_ids(tiles, df, assess.LABEL_BOX)
        seed = 1 if settings.seed is False else int(settings.seed)
        kinds = stored(tilesets.tile_kinds(tiles, ids(truth), ids(others), ids(false)))
        kept = kinds.where("tile_kind <> 'empty'") if settings.keep_oth_tiles else kinds.where("tile_kind IN ('gt', 'fp')")
        if settings.empty_tiles is not None:
            kept = tilesets.with_empty(kinds, settings.empty_tiles_frac, settings.keep_oth_tiles, key, seed)
        if settings.debug and settings.debug_tiles:
            kept = tilesets.debug_subset(kept, kinds.where("tile_kind = 'gt'"), settings.debug_tiles, key)
        kept = stored(kept)
        if settings.seed is False:
            counts = tilesets.labels_per_tile(kept.where("tile_kind = 'gt'"), truth, assess.LABEL_BOX, "label_class").join(kept.select("id", key), "id")
            best = tilesets.seed_scores(counts, "label_class", key).orderBy(F.desc("score"), "seed").first()
            seed = best.seed if best else tilesets.SEEDS.start
        shares = {"gt": 0.7, "fp": settings.fp_frac_trn, "empty": settings.empty_frac_trn}
        found = tilesets.split_kinds(kept, key, shares, seed=seed)
    out = {"tiles": found}
    if settings.source_type == "XYZ":
        placed = config.check_tiles(found.select("id", "dataset", *(["year_tile"] if "year_tile" in found.columns else [])))
        out["tasks"] = connectors.xyz_tasks(placed, settings.source_location, settings.source_year)
    return out


def assess_detections(settings: config.Assessment, dets: DataFrame, tiles: DataFrame, truth: DataFrame | None, others: DataFrame | None, categories: DataFrame) -> dict[str, DataFrame]:
    """labels, swept, threshold, tagged, metrics_by_class, global_metrics, confusion.

    Detections as in assess, tiles with id, TILE_BOX and dataset, labels with LABEL_BOX, category and, if years count, year;
    categories with id and name. Labels are clipped by the tiles, whose dataset they take, and numbered by tile and place. A
    threshold in the settings goes before the one of the highest F1 on the set val; without either it is an error.
    """
    given = [df for df in (truth, others) if df is not None]
    if not given:
        raise ValueError("an assessment needs labels")
    year = "year" if all("year" in df.columns for df in given) else None
    every = given[0].select("category", *([year] if year else []), *assess.LABEL_BOX)
    for df in given[1:]:
        every = every.unionByName(df.select("category", *([year] if year else []), *assess.LABEL_BOX))
    clipped = coco.clip_boxes(tiles.select(F.col("id").alias("tile"), "dataset", *tilesets.TILE_BOX), tilesets.TILE_BOX, every, assess.LABEL_BOX, CLIP_SCALE)
    named = clipped.join(F.broadcast(categories.select(F.col("id").cast("int").alias("label_class"), F.col("name").alias("category"))), "category")  # a row each
    parts = named.select("dataset", "tile", "category", "label_class", F.col(year).cast("int").alias("year_label") if year else F.lit(None).cast("int").alias("year_label"), *(F.col(f"c_{c[2:]}").alias(c) for c in assess.LABEL_BOX), F.lit(0).alias("_all"))
    labels = stored(coco.number(parts, "_all", "tile", *assess.LABEL_BOX, "label_class", name="label_id").drop("_all").withColumn("label_id", F.col("label_id").cast("long")))

    classes = categories.select(F.col("id").cast("int").alias("class"))
    dets = stored(dets)
    # Each detection's label doesn't depend on a score threshold, so the sweep and the sets share it.
    matches = assess.best_matches(dets, labels, settings.iou_threshold, by_dataset=True)
    swept = stored(assess.threshold_sweep(dets, labels, classes, settings.iou_threshold, matches))
    best = assess.best_threshold(swept, method=settings.metrics_method).collect()  # one row
    threshold = settings.confidence_threshold if settings.confidence_threshold else best[0].threshold / 100 if best else None
    if threshold is None:
        raise ValueError("no confidence_threshold is set and there is no validation set to find one")
    found = F.col("score") >= threshold
    tagged = stored(assess.fractional_sets(dets.where(found), labels, settings.iou_threshold, settings.area_threshold, by_dataset=True, best=matches.where(found)))
    by_class = assess.class_counts(tagged, classes, "dataset")
    return {
        "labels": labels, "swept": swept, "threshold": dets.sparkSession.createDataFrame([(float(threshold),)], "threshold double"), "tagged": tagged,
        "metrics_by_class": by_class.join(F.broadcast(categories.select(F.col("id").cast("int").alias("class"), F.col("name").alias("category"))), "class", "left"),
        "global_metrics": assess.metrics(by_class, "dataset", method=settings.metrics_method), "confusion": assess.confusion_matrix(tagged.where(F.col("tag") != assess.SMALL)),
    }


def merge_detections(settings: config.Merging, dets: DataFrame, tiles: DataFrame, categories: DataFrame) -> dict[str, DataFrame]:
    """detections: those merged across tile borders, of each year, with a score above the threshold and det_category;
    within: those that lay whole in a tile, which have no score of their own and so stay out of the first table."""
    merged, _, within = post.merge_across_tiles(dets, tiles, tilesets.TILE_BOX, settings.distance)
    names = categories.select((F.col("id") - 1).cast("int").alias("det_class"), F.col("name").alias("det_category"))
    kept = merged.where(F.col("score") > settings.score_threshold).join(F.broadcast(names), "det_class", "left")  # a row each
    return {"detections": kept, "within": within}


def filter_detections(settings: config.Filtering, dets: DataFrame, heights: DataFrame | None = None, x0: float = 0.0, y1: float = 0.0, size: float = 1.0) -> dict[str, DataFrame]:
    """detections: those above the score and area thresholds and, with a raster of heights (row, col, elevation) whose upper
    left corner and pixel size are given, on ground that is known and below the elevation threshold."""
    kept = post.filter_detections(dets, settings.score_threshold, settings.area_threshold)
    if heights is not None:
        kept = post.filter_elevation(kept, heights, x0, y1, size, settings.elevation_threshold)
    return {"detections": kept}
