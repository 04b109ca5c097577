"""Classes of tiles, sampling of empty ones, and splits into training, validation and test sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.operators.spatial import spatial_join
from geoloom.storage import stored

TILE_BOX = ("t_x0", "t_y0", "t_x1", "t_y1")
SEEDS = range(50)
#: The least shares of a class that a good split gives to training, validation and test.
LEAST_SHARES = (0.60, 0.12, 0.12)


def met_ids(tiles: DataFrame, labels: DataFrame, label_box) -> DataFrame:
    """Ids of the tiles that meet a label."""
    return spatial_join(tiles.select("id", *TILE_BOX), TILE_BOX, labels.select(*label_box), label_box, 128).select("id").distinct()


def labels_per_tile(tiles: DataFrame, labels: DataFrame, label_box, class_col: str) -> DataFrame:
    pairs = spatial_join(tiles.select("id", *TILE_BOX), TILE_BOX, labels.select(class_col, *label_box), label_box, 128)
    return pairs.groupBy("id", class_col).agg(F.count(F.lit(1)).alias("n"))


def tile_kinds(tiles: DataFrame, gt_ids: DataFrame, oth_ids: DataFrame | None = None, fp_ids: DataFrame | None = None) -> DataFrame:
    """tiles with tile_kind: gt meets ground truth and no other label, fp meets false positives and no ground truth,
    oth meets other labels, empty meets nothing."""
    out = tiles
    for name, ids in (("gt", gt_ids), ("oth", oth_ids), ("fp", fp_ids)):
        flag = F.lit(False) if ids is None else F.coalesce(F.col(f"_{name}"), F.lit(False))
        if ids is not None:
            out = out.join(ids.select("id").distinct().withColumn(f"_{name}", F.lit(True)), "id", "left")
        out = out.withColumn(f"_{name}", flag)
    kind = F.when(F.col("_gt") & ~F.col("_oth"), "gt").when(F.col("_fp") & ~F.col("_gt"), "fp").when(F.col("_oth"), "oth").otherwise("empty")
    return out.withColumn("tile_kind", kind).drop("_gt", "_oth", "_fp")


def place(key: Column, seed: int | Column) -> Column:
    """A seeded place in an order of whole-number ids that any engine can repeat."""
    return (key * 7919 + seed * 104729) % 1000003


#: Bits of a digit in a selection: a histogram of one has so many rows at most as this power of two.
DIGIT = 16


def _digits(key: Column, seed: int | Column) -> list[Column]:
    """The order by seeded place and then by key as digits, the highest first."""
    at, shifted = place(key, seed), key.cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    mask = F.lit((1 << DIGIT) - 1)
    return [F.shiftright(at, DIGIT), at.bitwiseAND(mask), *(F.shiftrightunsigned(shifted, k).bitwiseAND(mask) for k in (48, 32, 16, 0))]


def least(df: DataFrame, n: int, digits: Sequence[Column]) -> Column:
    """A condition that holds for the n least rows of df in the order of digits, and for all rows equal to the last of them.

    The n-th row is found digit by digit: a histogram of each digit over the rows that share the ones before. Nothing is
    sorted, no row leaves its task, and the driver gets a histogram at a time.
    """
    if n <= 0:
        return F.lit(False)
    found, same, left = F.lit(False), F.lit(True), n
    for digit in digits:
        bins = sorted((r.digit, r["count"]) for r in df.where(same).groupBy(digit.alias("digit")).count().collect())
        if sum(c for _, c in bins) <= left:
            break
        for value, count in bins:
            if count >= left:
                break
            left -= count
        found, same = found | (same & (digit < value)), same & (digit == value)
        if count == left:
            break
    return found | same


def sample_ids(ids: DataFrame, n: int, key: str = "key", seed: int = 1) -> DataFrame:
    """n of ids by seeded place, all if they are fewer: this limit is the feature. Ids of equal key go together."""
    return ids.where(least(ids, n, _digits(F.col(key), seed)))


def split_sizes(tiles: DataFrame, key: str = "key", by: str | None = None, frac_trn: float = 0.7, frac_left_val: float = 0.5, seed: int = 1) -> DataFrame:
    """tiles with dataset, cut by seeded place so that the sizes are exactly round(frac_trn * n) for training and
    round(frac_left_val * rest) for validation, within each value of by if given. Values of by are few."""
    known = stored(tiles.select(key, *([by] if by else [])))  # read a few times for each value
    groups = [None] if by is None else [r[0] for r in known.select(by).distinct().collect()]
    digits, dataset = _digits(F.col(key), seed), F.lit("tst")
    for value in groups:
        here = F.lit(True) if by is None else F.col(by).eqNullSafe(F.lit(value))
        own = known.where(here).select(key)
        n = own.count()
        trn = round(frac_trn * n)
        val = trn + round(frac_left_val * (n - trn))
        dataset = F.when(here & least(own, trn, digits), "trn").when(here & least(own, val, digits), "val").otherwise(dataset)
    return tiles.withColumn("dataset", dataset)


def empty_tile_count(n_gt: int, n_fp: int, frac: float = 0.5) -> int:
    return max(0, int(frac * (n_gt - n_fp)))


def split(tiles: DataFrame, key: str = "key", by: str | None = None, frac_trn: float = 0.7, frac_left_val: float = 0.5, seed: int = 1, places: int = 1000) -> DataFrame:
    """tiles with dataset: seeded places cut into trn, val and tst.

    The cuts lie at shares of the ids' places, so no rank over all tiles and no shuffle is needed; sizes meet the
    fractions as nearly as the places spread. by adds its value to the seed, so kinds of tiles split on their own.
    """
    salt = F.lit(seed) if by is None else F.lit(seed) + F.crc32(F.col(by).cast("string")) % 1000
    return tiles.withColumn("dataset", _cut(place(F.col(key), salt) % places, frac_trn, frac_left_val, places))


def _cut(at: Column, frac_trn: float, frac_left_val: float, places: int) -> Column:
    trn, val = round(frac_trn * places), round((frac_trn + (1 - frac_trn) * frac_left_val) * places)
    return F.when(at < trn, "trn").when(at < val, "val").otherwise("tst")


def split_kinds(kinds: DataFrame, key: str = "key", fractions: dict[str, float] | None = None, frac_left_val: float = 0.5, seed: int = 1, places: int = 1000) -> DataFrame:
    """kinds (tile_kinds()) with dataset: each kind of fractions is cut by its own share for training with the same seed.

    Without fractions, ground truth, false positives and empty tiles give 0.7. Tiles of another kind are in the set oth.
    """
    shares = {"gt": 0.7, "fp": 0.7, "empty": 0.7} if fractions is None else fractions
    at, dataset = place(F.col(key), seed) % places, F.lit("oth")
    for kind, share in shares.items():
        dataset = F.when(F.col("tile_kind") == kind, _cut(at, share, frac_left_val, places)).otherwise(dataset)
    return kinds.withColumn("dataset", dataset)


def split_exact(tiles: DataFrame, seed: int = 1, frac_trn: float = 0.7, frac_left_val: float = 0.5, max_tiles: int = 1_000_000) -> DataFrame:
    """The split that numpy's RandomState(seed) draws from tiles in id order; for up to max_tiles ids."""
    import numpy as np

    ids = [r.id for r in tiles.select("id").orderBy("id").limit(max_tiles + 1).collect()]
    if len(ids) > max_tiles:
        raise ValueError(f"more than {max_tiles} tiles: use split()")
    draw = lambda pool, frac: set(np.random.RandomState(seed).choice(len(pool), round(frac * len(pool)), replace=False).tolist()) if pool else set()
    first = draw(ids, frac_trn)
    rest = [i for k, i in enumerate(ids) if k not in first]
    second = draw(rest, frac_left_val)
    val = {i for k, i in enumerate(rest) if k in second}
    rows = [(i, "trn" if k in first else "val" if i in val else "tst") for k, i in enumerate(ids)]
    return tiles.join(tiles.sparkSession.createDataFrame(rows, "id string, dataset string"), "id", "left")


def split_ratios(counts: DataFrame, assigned: DataFrame, class_col: str) -> DataFrame:
    """(class, trn_ratio, val_ratio, tst_ratio): the shares of a class's labels in each set."""
    part = lambda d: (F.sum(F.when(F.col("dataset") == d, F.col("n")).otherwise(0)) / F.sum("n")).alias(f"{d}_ratio")
    return counts.join(assigned.select("id", "dataset"), "id").groupBy(class_col).agg(*(part(d) for d in ("trn", "val", "tst")))


def seed_scores(counts: DataFrame, class_col: str, key: str = "key", frac_trn: float = 0.7, frac_left_val: float = 0.5) -> DataFrame:
    """(seed, score) of all SEEDS in one pass: one point for each class and set that gets its least share, one less for
    a class without labels in a set. counts has (key, class, n)."""
    seeds = counts.withColumn("seed", F.explode(F.sequence(F.lit(SEEDS.start), F.lit(SEEDS.stop - 1))))
    trn, val = round(frac_trn * 1000), round((frac_trn + (1 - frac_trn) * frac_left_val) * 1000)
    at = place(F.col(key), F.col("seed")) % 1000
    cut = seeds.withColumn("dataset", F.when(at < trn, 0).when(at < val, 1).otherwise(2))
    per = cut.groupBy("seed", class_col).agg(*(F.sum(F.when(F.col("dataset") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(3)))
    total = F.col("n0") + F.col("n1") + F.col("n2")
    points = sum(((F.col(f"n{k}") / total >= least).cast("int") for k, least in enumerate(LEAST_SHARES)), F.lit(0))
    points -= ((F.col("n0") == 0) | (F.col("n1") == 0) | (F.col("n2") == 0)).cast("int")
    return per.groupBy("seed").agg(F.sum(points).alias("score"))


def chosen_split(tiles: DataFrame, counts: DataFrame, class_col: str, key: str = "key", frac_trn: float = 0.7, frac_left_val: float = 0.5) -> DataFrame:
    """tiles with dataset, split by the seed of the best score; ties take the lowest seed. Without labels it is SEEDS' first."""
    best = seed_scores(counts, class_col, key, frac_trn, frac_left_val).orderBy(F.col("score").desc(), "seed").first()  # a row for each seed
    return split(tiles, key, frac_trn=frac_trn, frac_left_val=frac_left_val, seed=best.seed if best else SEEDS.start)


def without_ground_truth(tiles: DataFrame) -> DataFrame:
    """tiles with dataset oth: what a set without ground truth is."""
    return tiles.withColumn("dataset", F.lit("oth"))


def with_empty(kinds: DataFrame, frac: float = 0.5, keep_oth: bool = True, key: str = "key", seed: int = 1) -> DataFrame:
    """Tiles of kinds (tile_kinds()) with a sample of the empty ones: frac of what ground truth has more than false positives.

    keep_oth=False drops tiles of other labels.
    """
    n = {r.tile_kind: r["count"] for r in kinds.groupBy("tile_kind").count().collect()}  # four kinds
    some = sample_ids(kinds.where("tile_kind = 'empty'").select("id", key), empty_tile_count(n.get("gt", 0), n.get("fp", 0), frac), key, seed)
    kept = kinds.where(F.col("tile_kind").isin(*(["gt", "fp", "oth"] if keep_oth else ["gt", "fp"])))
    return kept.unionByName(kinds.join(some.select("id"), "id", "left_semi"))


def debug_subset(tiles: DataFrame, labelled: DataFrame, n: int, key: str = "key") -> DataFrame:
    """n of tiles, those with labels first and then by key: a small set to try things on."""
    flagged = tiles.join(labelled.select("id").distinct().withColumn("_first", F.lit(True)), "id", "left")
    return flagged.orderBy(F.col("_first").isNull(), key).limit(max(0, n)).drop("_first")


def common_ids(*sets: DataFrame) -> DataFrame:
    """Ids that all sets have."""
    out = sets[0].select("id")
    for other in sets[1:]:
        out = out.intersect(other.select("id"))
    return out


def class_occurrence(counts: DataFrame, assigned: DataFrame, class_col: str) -> DataFrame:
    """(dataset, class, n): the labels of each class in each set. counts has (id, class, n)."""
    return counts.join(assigned.select("id", "dataset"), "id").groupBy("dataset", class_col).agg(F.sum("n").alias("n"))


def category_ids(labels: DataFrame, category: str = "category", supercategory: str = "supercategory") -> DataFrame:
    """(id, name, supercategory) from 1 in sorted order; null names get none. Categories are few by nature."""
    from pyspark.sql import Window

    found = labels.select(F.col(category).alias("name"), F.col(supercategory).alias("supercategory")).na.drop().distinct()
    return found.select(F.row_number().over(Window.orderBy("name", "supercategory")).alias("id"), "name", "supercategory")


def known_categories(labels: DataFrame | None, configured: DataFrame | None = None, saved: DataFrame | None = None) -> DataFrame:
    """category_ids() of labels (CATEGORY, SUPERCATEGORY); without labels those configured or else saved, both as names and
    supercategories, and without these one made-up category. An empty table counts as absent; the others keep their order."""
    if labels is not None and labels.limit(1).count():
        return category_ids(labels, "CATEGORY", "SUPERCATEGORY")
    for given in (configured, saved):
        if given is not None and given.limit(1).count():
            rows = [tuple(r) for r in given.select("name", "supercategory").collect()]  # categories are few by nature
            return given.sparkSession.createDataFrame([(k, *r) for k, r in enumerate(rows, 1)], "id int, name string, supercategory string")
    spark = next(df for df in (labels, configured, saved) if df is not None).sparkSession
    return spark.createDataFrame([(1, "foo", "bar ")], "id int, name string, supercategory string")
