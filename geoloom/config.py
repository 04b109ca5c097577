"""Settings of each job by the keys of its configuration file, and the rules that inputs must keep.

Each field names its key as a path of a nested mapping. A key without a default must be there; keys that no field names
are left alone, so one file can serve several jobs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions.names import parse_tile_id
from geoloom.sources.tables import assert_unique

#: Kinds of image sources; those of the first line can hold several years.
YEARLY, TIMELESS = ("XYZ", "FOLDER"), ("WMS", "MIL")
MULTI = "multi-year"
METHODS = ("macro-average", "macro-weighted-average", "micro-average")
_NONE = object()


def key(path: str, default: Any = _NONE, share: bool = False, among: Sequence[Any] = ()) -> Any:
    """A field read from path; share: a number from 0 to 1, among: one of these."""
    return field(metadata={"path": path, "default": default, "share": share, "among": among})


def load(kind: type, mapping: Mapping[str, Any]) -> Any:
    """The settings of a kind below from a mapping; a missing key or a value out of range is an error that names it."""
    values = {}
    for f in fields(kind):
        rule, at = f.metadata, mapping
        for name in rule["path"].split("."):
            at = at.get(name, _NONE) if isinstance(at, Mapping) else _NONE
        if at is _NONE:
            at = rule["default"]
        if at is _NONE:
            raise ValueError(f"{rule['path']} is missing")
        if rule["share"] and at is not None and not 0 <= at <= 1:
            raise ValueError(f"{rule['path']} must lie between 0 and 1")
        if rule["among"] and at not in rule["among"]:
            raise ValueError(f"{rule['path']} must be one of {', '.join(map(str, rule['among']))}")
        values[f.name] = at
    return kind(**values)


def load_file(kind: type, path: str, section: str) -> Any:
    """The settings in a section of a YAML file; needs a YAML reader."""
    import yaml

    with open(path) as f:
        return load(kind, yaml.safe_load(f).get(section) or {})


@dataclass(frozen=True)
class Tilesets:
    """Tiles, their images and their split. seed 0 or False: search for one."""

    output_folder: str = key("output_folder")
    aoi_tiles: str = key("datasets.aoi_tiles")
    source_type: str = key("datasets.image_source.type", among=(*YEARLY, *TIMELESS))
    source_location: str = key("datasets.image_source.location")
    source_srs: str | None = key("datasets.image_source.srs", None)
    source_year: int | str | None = key("datasets.image_source.year", None)
    source_layers: str | None = key("datasets.image_source.layers", None)
    ground_truth_labels: str | None = key("datasets.ground_truth_labels", None)
    other_labels: str | None = key("datasets.other_labels", None)
    fp_labels: str | None = key("datasets.add_fp_labels.fp_labels", None)
    fp_frac_trn: float = key("datasets.add_fp_labels.frac_trn", 0.7, share=True)
    empty_tiles: Mapping | None = key("empty_tiles", None)
    empty_tiles_frac: float = key("empty_tiles.tiles_frac", 0.5)
    keep_oth_tiles: bool = key("empty_tiles.keep_oth_tiles", True)
    empty_frac_trn: float = key("empty_tiles.frac_trn", 0.7, share=True)
    debug: bool = key("debug_mode.enable", False)
    debug_tiles: int | None = key("debug_mode.nb_tiles_max", None)
    tile_size: int | None = key("tile_size", None)
    seed: int | bool = key("seed", False)
    coco: Mapping | None = key("COCO_metadata", None)


@dataclass(frozen=True)
class Detections:
    """What is done with a model's output."""

    coco_files: Mapping = key("COCO_files")
    output_folder: str = key("output_folder", ".")
    score_lower_threshold: float = key("score_lower_threshold", share=True)
    image_metadata: str = key("image_metadata_json")
    simplify: bool = key("rdp_simplification.enabled", False)
    epsilon: float = key("rdp_simplification.epsilon", 0.0)
    remove_det_overlap: bool = key("remove_det_overlap", False)


@dataclass(frozen=True)
class Assessment:
    """Detections against labels."""

    detections: Mapping = key("datasets.detections")
    split_aoi_tiles: str = key("datasets.split_aoi_tiles")
    categories: str | None = key("datasets.categories", None)
    ground_truth_labels: str | None = key("datasets.ground_truth_labels", None)
    other_labels: str | None = key("datasets.other_labels", None)
    crs_out: int = key("crs_out", 2056)
    confidence_threshold: float | None = key("confidence_threshold", None, share=True)
    iou_threshold: float = key("iou_threshold", 0.25, share=True)
    area_threshold: float | None = key("area_threshold", None)
    metrics_method: str = key("metrics_method", among=METHODS)


@dataclass(frozen=True)
class Merging:
    """Detections over tile borders."""

    detections: Mapping = key("detections")
    distance: float = key("distance")
    score_threshold: float = key("score_threshold", share=True)


@dataclass(frozen=True)
class Filtering:
    """Detections by score, area and elevation."""

    detections: str = key("detections")
    dem: str | None = key("dem", None)
    score_threshold: float = key("score_threshold", share=True)
    area_threshold: float = key("area_threshold")
    elevation_threshold: float | None = key("elevation_threshold", None)


@dataclass(frozen=True)
class BorderPoints:
    """Clusters of border points."""

    detections: Mapping = key("detections")
    subtiles: str = key("subtiles")
    tiles: str = key("tiles")
    categories: str = key("category_ids_json")
    score: float = key("score", share=True)
    keep_datasets: bool = key("keep_datasets", False)


@dataclass(frozen=True)
class Tiling:
    """Tiles over labels."""

    labels: str = key("datasets.shapefile")
    fp_labels: str | None = key("datasets.fp_shapefile", None)
    category: str | None = key("datasets.category", None)
    zoom_level: int = key("zoom_level", among=range(31))
    output_folder: str = key("output_folder")


@dataclass(frozen=True)
class BandStatistics:
    working_directory: str = key("working_directory")
    tiles: str = key("tiles")


def check_tile_year(source: str, year: int | str | None, columns: Sequence[str]) -> int | str | None:
    """The year that tasks of this image source use: a number, MULTI for the tiles' own year_tile, or None.

    Sources of several years need year_tile exactly for MULTI. The others drop a year that is set, and refuse year_tile if
    none is.
    """
    own = "year_tile" in columns
    if source in YEARLY:
        if (year == MULTI) != own:
            raise ValueError(f"tiles have year_tile if and only if the year is {MULTI}: year {year}, year_tile {'there' if own else 'missing'}")
        return year
    if source not in TIMELESS:
        raise ValueError(f"unknown image source {source}")
    if own and not year:
        raise ValueError(f"{source} knows no years, but the tiles have year_tile")
    return None


def check_false_years(labels: Sequence[str], false: Sequence[str]) -> None:
    """Labels and false positives must both have a year or both lack it."""
    if ("year" in labels) != ("year" in false):
        raise ValueError("either labels or false positives lack the year that the others have")


def check_empty_years(labels: Sequence[str], empty: Sequence[str], year: int | None) -> None:
    """Empty tiles must have a year, their own or a set one, exactly if labels have one."""
    if ("year" in labels) != ("year" in empty or year is not None):
        raise ValueError("either labels or empty tiles lack the year that the others have")


def check_tiles(tiles: DataFrame) -> DataFrame:
    """tiles with x, y, z of their ids, and t if they have year_tile; a missing or repeated id, or one of other parts, is an error."""
    if "id" not in tiles.columns:
        raise ValueError("tiles need a column id")
    yearly = "year_tile" in tiles.columns
    found = parse_tile_id(F.col("id"))
    right = found.isNotNull() & F.col("id").rlike(r"^\(.*\)$") & (found["t"].isNotNull() if yearly else found["t"].isNull())
    lost = F.raise_error(F.concat(F.lit("not a tile's id: "), F.col("id")))
    parts = assert_unique(tiles, "id").withColumn("_id", F.when(right, found).otherwise(lost))
    return parts.select(*tiles.columns, *(F.col(f"_id.{c}").alias(c) for c in (["t"] if yearly else []) + ["x", "y", "z"])).drop("_id")
