"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame operations only.

The mix holds a share of all words. Sources get targets by weight, none above a multiple of its size. Targets become
whole blocks of equal word counts by highest quotients (weight / (2k+1)); a source's blocks are dealt to its shards by
the same rule, weighted by the shards' words. Within a shard the documents stand in a seeded order on a circle of
words cut into blocks, and the shard's quota is the run of blocks that begins at a seeded one: whole rounds repeat every
document, the rest takes some of them, at most two in part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm.line_dedup import hash60
from geoloom.storage import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
BLOCK_WORDS = 16
SEED = 17
#: A source table of up to so many rows is sent to the tasks; a longer one is joined by shuffle.
FEW_SOURCES = 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """Rows (source, source_size, docs) with rank, weight and target: one row for each source of a mix.

    Sources stand by code point, null last, and take the weights in turn. With sources by rising cap per weight, the
    level at which the rest share what the capped ones leave is the highest that any prefix of capped ones gives.
    """
    every = Window.partitionBy(F.lit(0))
    by_name = every.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    listed = F.array(*(F.lit(float(w)) for w in weights))
    ranked = ranked.withColumn("weight", listed[F.pmod(F.col("rank"), F.lit(len(weights)))])
    ranked = ranked.withColumn("cap", (F.col("source_size") * repeats).cast("double"))
    earlier = every.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    used = lambda c: F.sum(c).over(every) * (share if c == "source_size" else 1.0)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0.0))
    level = (used("source_size") - before("cap")) / (used("weight") - before("weight"))
    ranked = ranked.withColumn("level", level)
    ranked = ranked.withColumn("level", F.max("level").over(every))
    return ranked.withColumn("target", F.least("cap", F.col("weight") * F.col("level"))).select("source", "source_size", "docs", "rank", "target")


def apportion(rows: DataFrame, group: str, weight: str, seats: str, rank: str) -> DataFrame:
    """rows with quota: the seats of each group by highest quotients weight / (2k+1), ties to the lower rank.

    Rounding weight / (group's weight per seat) leaves a difference below half the rows of a group, so a row's quota
    lies within slack = 1.5 rows * its share + 1 of that; only quotients in this range compete.
    """
    per = Window.partitionBy(group)
    sized = rows.withColumn("_all", F.sum(weight).over(per)).withColumn("_n", F.count(F.lit(1)).over(per))
    part = F.when(F.col("_all") > 0, F.col(weight) / F.col("_all")).otherwise(0.0)
    near = F.floor(part * F.col(seats) + 0.5)
    slack = F.ceil(1.5 * F.col("_n") * part) + 1
    sized = sized.withColumn("_low", F.greatest(F.lit(0), near - slack)).withColumn("_high", near + slack)
    sized = sized.withColumn("_left", F.col(seats) - F.sum("_low").over(per))
    bids = sized.where("_all > 0").select(group, rank, "_left", F.col(weight).alias("_w"), F.explode(F.sequence("_low", "_high")).alias("_k"))
    order = Window.partitionBy(group).orderBy((F.col("_w") / (2 * F.col("_k") + 1)).desc(), rank)
    won = bids.withColumn("_place", F.row_number().over(order)).where("_place <= _left").groupBy(group, rank).agg(F.count(F.lit(1)).alias("_won"))
    out = sized.join(won, [group, rank], "left").withColumn("quota", F.when(F.col("_all") > 0, F.col("_low") + F.coalesce("_won", F.lit(0))).otherwise(0))
    return out.drop("_all", "_n", "_low", "_high", "_left", "_won")


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", keep: list[str] | None = None,
    weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS, block_words: int = BLOCK_WORDS, seed: int = SEED,
) -> DataFrame:
    """(id, keep..., size, source_size, target, taken) for every row of docs.

    size counts the words [^\\x20\\x09-\\x0D]+ of the whole text (null or none: 0); taken counts the words that the mix
    takes of the row, repeats included, and is at most repeats * size. A null source is a source; null ids and
    repeated rows are rows like others (rows equal in id and size may stand for each other). All sizes 0: nothing is
    taken. An empty table gives an empty result. Reruns agree: the seed alone decides.
    """
    name = lambda *parts: hash60(F.concat_ws(":", F.lit(str(seed)), *parts))
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), word_count(F.col(text_col).cast("string")).alias("_size"),
        *(F.col(c).alias(f"_keep_{k}") for k, c in enumerate(keep or [])),
    ).withColumn("_order", name(F.coalesce(F.col("_id").cast("string"), F.lit("-"))))
    if not keep:
        rows = cut_lineage(rows)
    sizes = rows.groupBy("_source").agg(F.sum("_size").alias("source_size"), F.count(F.lit(1)).alias("docs")).withColumnRenamed("_source", "source")
    sources = targets(sizes, weights, share, repeats)
    sources = sources.withColumn("_one", F.lit(0)).withColumn("_blocks", F.floor(F.sum("target").over(Window.partitionBy(F.lit(0))) / block_words + 1e-9))
    sources = apportion(sources, "_one", "target", "_blocks", "rank").withColumn("shards", F.ceil(F.sqrt("docs")))
    sources = cut_lineage(sources.select("source", "source_size", "target", "rank", "quota", "shards"))
    dealt = F.broadcast(sources) if sources.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES else sources
    rows = rows.join(dealt.select("source", "source_size", "target", "rank", "shards", F.col("quota").alias("blocks")), rows["_source"].eqNullSafe(F.col("source")))
    rows = rows.withColumn("shard", F.pmod(F.col("_order"), F.col("shards")))
    shards = rows.groupBy("rank", "shard", "blocks").agg(F.sum("_size").cast("double").alias("words"))
    shards = apportion(shards, "rank", "words", "blocks", "shard").select("rank", "shard", F.col("words").cast("long").alias("words"), F.least(F.col("quota") * block_words, F.col("words") * repeats).cast("long").alias("take"))
    first = F.pmod(name("rank", "shard"), F.greatest(F.lit(1), F.ceil(F.col("words") / block_words))) * block_words
    shards = shards.withColumn("first", first).withColumn("rounds", F.when(F.col("words") > 0, F.expr("take div words")).otherwise(F.lit(0)))
    shards = shards.withColumn("rest", F.col("take") - F.col("rounds") * F.col("words"))
    line = Window.partitionBy("rank", "shard").orderBy("_order", F.col("_id").asc_nulls_last(), "_size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("_end", F.sum("_size").over(line)).join(shards, ["rank", "shard"])
    start, end = F.col("_end") - F.col("_size"), F.col("_end")
    shared = lambda low, high: F.greatest(F.lit(0), F.least(end, high) - F.greatest(start, low))
    stop = F.col("first") + F.col("rest")
    taken = F.col("rounds") * F.col("_size") + shared(F.col("first"), F.least(stop, F.col("words"))) + shared(F.lit(0), stop - F.col("words"))
    return placed.select(
        F.col("_id").alias(id_col), *(F.col(f"_keep_{k}").alias(c) for k, c in enumerate(keep or []) if c != id_col),
        F.col("_size").alias("size"), "source_size", "target", taken.cast("long").alias("taken"),
    )


def oracle(rows: str = "SELECT doc_id AS id, source, text FROM documents", weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS, block_words: int = BLOCK_WORDS, seed: int = SEED) -> str:
    """DuckDB SQL for mix() over rows (id, source, text)."""
    h60 = lambda x: f"CAST('0x' || substr(md5({x}), 1, 15) AS BIGINT)"

    def seats(name: str, of: str, group: str, weight: str, total: str, rank: str) -> str:
        return f"""{name}_near AS (SELECT *, CASE WHEN sum({weight}) OVER g > 0 THEN {weight} / sum({weight}) OVER g ELSE 0 END AS part, count(*) OVER g AS cnt FROM {of} WINDOW g AS (PARTITION BY {group})),
{name}_range AS (SELECT *, CAST(greatest(0, floor(part * {total} + 0.5) - ceil(1.5 * cnt * part) - 1) AS BIGINT) AS low, CAST(floor(part * {total} + 0.5) + ceil(1.5 * cnt * part) + 1 AS BIGINT) AS high FROM {name}_near),
{name}_left AS (SELECT *, {total} - sum(low) OVER (PARTITION BY {group}) AS remaining FROM {name}_range),
{name}_bids AS (SELECT {group} AS g, {rank} AS r, remaining, {weight} AS w, unnest(generate_series(low, high)) AS k FROM {name}_left WHERE part > 0 OR {weight} = 0),
{name}_won AS (SELECT g, r, count(*) AS won FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY w / (2 * k + 1) DESC, r) AS place FROM {name}_bids) WHERE place <= remaining GROUP BY g, r),
{name} AS (SELECT l.*, CAST(l.low + coalesce(b.won, 0) AS BIGINT) AS quota FROM {name}_left l LEFT JOIN {name}_won b ON b.g = l.{group} AND b.r = l.{rank})"""

    return f"""
WITH sized AS (SELECT id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size, {h60(f"'{seed}:' || coalesce(CAST(id AS VARCHAR), '-')")} AS ord FROM ({rows})),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS docs FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sizes),
weighed AS (SELECT *, CAST(list_extract([{', '.join(f'{float(w)}::DOUBLE' for w in weights)}], CAST(rank % {len(weights)} + 1 AS BIGINT)) AS DOUBLE) AS weight, CAST(source_size * {repeats} AS DOUBLE) AS cap FROM ranked),
levels AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * CAST({share} AS DOUBLE) - coalesce(sum(cap) OVER earlier, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS lv
  FROM weighed WINDOW earlier AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
aimed AS (SELECT *, least(cap, weight * (max(lv) OVER ())) AS target, 0 AS one FROM levels),
summed AS (SELECT *, CAST(floor(sum(target) OVER () / {block_words} + 1e-9) AS BIGINT) AS nblocks FROM aimed),
{seats('sources', 'summed', 'one', 'target', 'nblocks', 'rank')},
rows_in AS (SELECT s.*, t.rank, t.source_size, t.target, t.quota AS blocks, s.ord % CAST(ceil(sqrt(t.docs)) AS BIGINT) AS shard FROM sized s JOIN sources t ON s.source IS NOT DISTINCT FROM t.source),
shard_words AS (SELECT rank, shard, blocks, CAST(sum(size) AS DOUBLE) AS words FROM rows_in GROUP BY rank, shard, blocks),
{seats('shards', 'shard_words', 'rank', 'words', 'blocks', 'shard')},
quotas AS (SELECT rank, shard, CAST(words AS BIGINT) AS words, CAST(least(quota * {block_words}, words * {repeats}) AS BIGINT) AS take,
  {h60(f"'{seed}:' || rank || ':' || shard")} % CAST(greatest(1, ceil(words / {block_words})) AS BIGINT) * {block_words} AS f FROM shards),
rounds AS (SELECT *, CASE WHEN words > 0 THEN take // words ELSE 0 END AS rounds FROM quotas),
placed AS (SELECT r.*, q.words, q.f, q.rounds, q.f + q.take - q.rounds * q.words AS stop, CAST(sum(r.size) OVER (PARTITION BY r.rank, r.shard ORDER BY r.ord, r.id NULLS LAST, r.size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fin
  FROM rows_in r JOIN rounds q ON r.rank = q.rank AND r.shard = q.shard)
SELECT id AS doc_id, size, source_size, target,
  CAST(rounds * size + greatest(0, least(fin, least(stop, words)) - greatest(fin - size, f)) + greatest(0, least(fin, stop - words) - (fin - size)) AS BIGINT) AS taken FROM placed"""
