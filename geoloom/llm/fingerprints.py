"""Document fingerprints by order MinHash.

A text's k-mers of code points are numbered by occurrence, so repeats count. Each of FUNCTIONS rank functions orders all
numbered k-mers by (hash - seed) mod 2**64; the PICK least of each are put back into text order, and their tuple is
hashed. The seeds lie at even distances, so one sorted list, or for a long text only what lies close behind a seed,
serves all functions. Two texts' shares of equal tuples follow their edit distance: moving text about changes tuples that
a set's signature would keep.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.textvec import GOLDEN, STEP, U, mix64

SIZE = 8
FUNCTIONS_LOG = 6
FUNCTIONS = 1 << FUNCTIONS_LOG
SEEDS = np.arange(FUNCTIONS, dtype=np.uint64) << U(64 - FUNCTIONS_LOG)
PICK = 2
#: Ranges of ids that one shuffle partition gets on average.
RANGES_PER_PARTITION = 4
#: Ranges by text hash that the rows of an id with more than a range's share of all rows are cut into.
CUTS_LOG = 6


def kmers(codes: np.ndarray) -> np.ndarray:
    """Hashes of a text's k-mers of SIZE = 8 code points in order; a shorter text is one k-mer, an empty one has none."""
    c = codes.astype(np.uint64)
    if len(c) < SIZE:
        return mix64((c * STEP[: len(c)]).sum(keepdims=True) + np.full(1, len(c), np.uint64) * GOLDEN) if len(c) else c
    for step in (1, 2, 4):
        c = mix64(c[:-step] * STEP[step] + c[step:] * STEP[step + 8])
    return c


def fingerprint(text: str | None) -> np.ndarray:
    """FUNCTIONS numbers of 16 bits; all are 0 for an empty text, none is for others."""
    h = kmers(np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32))
    n = len(h)
    if not n:
        return np.zeros(FUNCTIONS, np.uint16)
    bits = U(n.bit_length())
    low = (U(1) << bits) - U(1)
    key = np.sort(h & ~low | np.arange(n, dtype=np.uint64))  # the place in the text stands in the lower bits
    kmer = key >> bits
    fresh = np.concatenate(([True], kmer[1:] != kmer[:-1]))
    where = np.arange(n)
    turn = where - np.maximum.accumulate(np.where(fresh, where, 0))
    pair = mix64((kmer << bits) + turn.astype(np.uint64) * GOLDEN) & ~low | key & low
    rest = 64 - FUNCTIONS_LOG
    room = min(1.0, 24.0 * PICK * FUNCTIONS / n)  # the least of each function lie almost surely in this share behind its seed
    if room < 1:
        near = np.sort(pair[(pair & U((1 << rest) - 1)) < U(int(room * float(1 << rest)))])
        enough = np.diff(np.append(np.searchsorted(near, SEEDS), len(near))) >= PICK
        pair = near if enough.all() else np.sort(pair)
    else:
        pair = np.sort(pair)
    least = pair[(np.searchsorted(pair, SEEDS)[:, None] + np.arange(min(PICK, n))) % len(pair)]
    tuples = np.take_along_axis(least & ~low, np.argsort(least & low, axis=1), 1)
    size = np.full(FUNCTIONS, tuples.shape[1], np.uint64)
    out = (mix64((tuples * STEP[: tuples.shape[1]]).sum(axis=1, dtype=np.uint64) + size * GOLDEN) >> U(48)).astype(np.uint16)
    out[out == 0] = 1
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal tuples; two empty texts are alike."""
    used = (a != 0) | (b != 0)
    return float((a[used] == b[used]).mean()) if used.any() else 1.0


def edit(text: str, following: str) -> str:
    """text with its last third (rounded down) replaced by as much of the beginning of following, or all of it."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _bounds(ids: DataFrame, count: int) -> tuple[list[int], list[int | None]]:
    """Lower bounds of ranges of ids, falling, and the ids with more than a range's share of rows, each a range of its own."""
    n = ids.count()
    heavy = [row.id for row in ids.groupBy("id").count().where(F.col("count") > max(1, n // count)).collect()]  # fewer than count
    row = ids.where("id IS NOT NULL").agg(F.percentile_approx("id", [k / count for k in range(1, count)], 10_000).alias("q")).first() if count > 1 else None
    named = [i for i in heavy if i is not None]
    return sorted({*(row.q if row and row.q else ()), *named, *(i + 1 for i in named)}, reverse=True), heavy


def fingerprint_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row of docs.

    The next row is the one of the next lower id, for the last row the first one; rows of equal id follow by a hash of
    their text, and null ids come last. Null texts count as empty. A single row follows itself. Fingerprints are
    hexadecimal, 4 digits a function. Ids are whole numbers. Other columns are not read; an empty table gives an empty
    result.

    Rows are dealt to ranges of ids, each with a copy of the first row of the range after it, so texts move once. An id
    with very many rows has ranges by text hash.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("hash"), "text")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found, heavy = _bounds(rows.select("id"), RANGES_PER_PARTITION * partitions)
    bounds = np.array(found, np.int64)
    large, no_id = np.array([i for i in heavy if i is not None], np.int64), None in heavy

    def ranges(ids: pa.Array, hashes: pa.Array) -> np.ndarray:
        """Range 0 holds the ids above the highest bound, and so on down; nulls are in the last."""
        none, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
        at = np.where(none, len(bounds) + 1, np.searchsorted(-bounds, -ids, "left"))
        cut = np.where(none, no_id, np.isin(ids, large))
        # hashes rise from negative ones on, so their upper bits do once the sign is turned
        upper = (hashes.to_numpy(zero_copy_only=False).view(np.uint64) ^ U(1 << 63)) >> U(64 - CUTS_LOG)
        return (at << CUTS_LOG) + np.where(cut, upper.astype(np.int64), 0)

    def number(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(ranges(*batch.columns)), *batch.columns], ["range", "id", "hash"])

    order = F.struct(F.col("id").isNull(), -F.col("id"), F.col("hash"))
    first = rows.select("id", "hash").mapInArrow(number, "range long, id long, hash long").groupBy("range").agg(F.min_by(F.struct("id", "hash"), order).alias("head"))
    heads = sorted((row.range, row.head.id, row.head.hash) for row in first.collect())  # a row for each range
    extra: dict[tuple, list[int]] = {}
    for k, (_, i, h) in enumerate(heads):
        extra.setdefault((i, h), []).append(heads[k - 1][0])
    marks = pa.array(sorted({h for _, _, h in heads}), pa.int64())

    def deal(batches):
        for batch in batches:
            ids, hashes, texts = batch.columns
            near = np.flatnonzero(pc.is_in(hashes, value_set=marks).to_numpy(zero_copy_only=False)).tolist()
            copies = [(k, to) for k in near for to in extra.get((ids[k].as_py(), hashes[k].as_py()), ())]
            take = pa.array([k for k, _ in copies], pa.int64())
            for part, at, halo in ((batch, ranges(ids, hashes), False), (batch.take(take), [to for _, to in copies], True)):
                if part.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array([halo] * part.num_rows), *part.columns], ["range", "halo", "id", "hash", "text"])

    parts = max(1, min(len(heads), partitions))
    dealt = rows.mapInArrow(deal, "range long, halo boolean, id long, hash long, text string").repartition(parts, "range")
    line = dealt.sortWithinPartitions("range", "halo", F.col("id").desc_nulls_last(), "hash", "text").drop("hash")

    def run(batches):
        pending, done = None, []
        for batch in batches:
            for at, halo, i, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if pending is None or pending[0] == at:
                    if halo and (pending is None or pending[1]):
                        continue
                    here = (at, halo, i, text, fingerprint(text))
                    if pending is not None:
                        done.append(_row(pending, here))
                    pending = here
                else:
                    pending = (at, halo, i, text, fingerprint(text))
                if len(done) >= 1000:
                    yield _rows(done)
                    done = []
        if done:
            yield _rows(done)

    return line.mapInArrow(run, ", ".join(f"{c} {k}" for c, k in COLUMNS.items())).withColumnRenamed("id", id_col)


COLUMNS = {"id": "long", "n_chars": "long", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"}


def _row(here: tuple, following: tuple) -> tuple:
    _, _, i, text, own = here
    edited = edit(text, following[3])
    changed = fingerprint(edited)
    sha = hashlib.sha256(edited.encode()).hexdigest()
    return i, len(text), sha, own.byteswap().tobytes().hex(), changed.byteswap().tobytes().hex(), likeness(own, changed), likeness(own, following[4])


def _rows(done: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for v, k in zip(zip(*done, strict=True), COLUMNS.values(), strict=True)], list(COLUMNS))
