"""Token-id output: raw id payloads in shards, each with a minimal perfect hash index over its document keys.

A file set is a Parquet folder, since Spark's committers make that safe on any store when executors are lost. Each row
is a shard: payload holds the ids of its documents one after another as little-endian unsigned 32-bit numbers, in
ascending id order over parts and shards. The index of n keys has ceil(n / KEYS_PER_PILOT) pilots and n slots: a key's
bucket names the pilot that, hashed with the key, gives its slot without collision; a slot holds the key, its 32-bit
fingerprint, where its ids begin and how many there are. A look-up reads one pilot and one slot. Beside its index a
shard has its least and highest key, by which Parquet's statistics lead a look-up to the few shards that can hold it.
"""

from __future__ import annotations

import os
import uuid
import zlib
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.bpe import SOLID, TextParts, byte_letters, flat, ragged
from geoloom.llm.textvec import GOLDEN, U, mix64, slices, tidy
from geoloom.storage import checkpoint_dir

END_ID = 2
SHARD_IDS = 1 << 18
SHARD_DOCS = 2048
KEYS_PER_PILOT = 4
#: Bytes of text that go to the library at a time, and of parts whose ids are kept for the next time.
SLICE_BYTES = 10 << 20
CACHE_BYTES = 8 << 20
#: Ranges of keys that a look-up of many keys asks the files for at most.
RANGES = 64
SHARDS = "part int, shard int, before long, ids long, low long, high long, keys binary, nulls binary, pilots binary, prints binary, starts binary, lengths binary, payload binary"


def key_hashes(keys: np.ndarray, nulls: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each key: id or null, and which turn of that id in its shard it is."""
    return mix64(mix64(keys.view(np.uint64) + U(1)) + turns.astype(np.uint64) * GOLDEN + nulls.astype(np.uint64) * U(0xA0761D6478BD642F))


def _slot(hashes, pilot, n: int):
    return (mix64(hashes ^ mix64(pilot * GOLDEN + U(1))) % U(n)).astype(np.int64)


def _bucket(hashes, n: int):
    return ((hashes >> U(33)) % U(-(-n // KEYS_PER_PILOT))).astype(np.int64)


def build_index(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pilots, and each key's slot: the keys' slots are 0 .. n-1, each once. Hashes must differ."""
    n = len(hashes)
    buckets = _bucket(hashes, n)
    order = np.argsort(buckets, kind="stable")
    first = np.searchsorted(buckets[order], np.arange(-(-n // KEYS_PER_PILOT) + 1))
    pilots, slots, free = np.zeros(len(first) - 1, np.uint32), np.zeros(n, np.int64), np.ones(n, bool)
    tries = 16
    for b in np.argsort(-np.diff(first), kind="stable"):
        members = order[first[b] : first[b + 1]]
        if not len(members):
            break
        pilot, step = 0, tries
        while True:
            some = np.arange(pilot, pilot + step, dtype=np.uint64)
            at = _slot(hashes[members][None, :], some[:, None], n)
            good = free[at].all(axis=1)
            if len(members) > 1:
                ranked = np.sort(at, axis=1)
                good &= (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
            if good.any():
                k = int(good.argmax())
                pilots[b], slots[members] = pilot + k, at[k]
                free[at[k]] = False
                break
            pilot, step = pilot + step, min(step * 4, 4096)
    return pilots, slots


def look_up(shard: dict, hashes: np.ndarray, keys: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length in the shard's payload of each key hash, and whether the stored fingerprint (and key) agrees."""
    pilots, prints = np.frombuffer(shard["pilots"], np.uint32), np.frombuffer(shard["prints"], np.uint32)
    if not len(prints):
        none = np.zeros(len(hashes), np.int64)
        return none, none, np.zeros(len(hashes), bool)
    slots = _slot(hashes, pilots[_bucket(hashes, len(prints))].astype(np.uint64), len(prints))
    known = prints[slots] == (hashes & U(0xFFFFFFFF)).astype(np.uint32)
    if keys is not None:
        known &= (np.frombuffer(shard["keys"], np.int64)[slots] == keys) & ~np.unpackbits(np.frombuffer(shard["nulls"], np.uint8))[slots].astype(bool)
    return np.frombuffer(shard["starts"], np.int64)[slots], np.frombuffer(shard["lengths"], np.int64)[slots], known


def _turns(keys: np.ndarray, nulls: np.ndarray) -> np.ndarray:
    """0 for the first of equal neighbours, 1 for the next, and so on."""
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (nulls[1:] != nulls[:-1])
    where = np.arange(len(keys))
    return where - np.maximum.accumulate(np.where(fresh, where, 0))


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    """The library's tokenizer, the ids of its special tokens, and how many bytes each id stands for."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    specials = {token.content: i for i, token in tokenizer.get_added_tokens_decoder().items()}
    letters = byte_letters()
    sizes = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for token, i in tokenizer.get_vocab().items():
        sizes[i] = len(token.encode()) if token in specials else sum(c in letters for c in token)
    return tokenizer, specials, sizes


def _library(path: str):
    """A text column -> (binary array of ids as little-endian 32-bit numbers) a slice, as the tokenizers library gives them.

    The library sees each distinct part once. Parts that begin at a space go to it as one text; the bytes that each
    token stands for tell where a part's tokens end.
    """
    tokenizer, specials, sizes = _tokenizer(path)

    def resolve(parts: pa.Array) -> pa.Array:
        begin, data = flat(parts)
        length = np.diff(begin)
        second = np.minimum(begin[:-1] + 1, max(len(data) - 1, 0))
        spaced = (length > 1) & (data[begin[:-1]] == 0x20) & SOLID[data[second]] if len(data) else np.zeros(len(length), bool)
        alone = parts.filter(pa.array(~spaced)).to_pylist()
        texts = ["".join(parts.filter(pa.array(spaced)).to_pylist()), *alone]
        ids = [np.array(e.ids, "<u4") for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.array([len(i) for i in ids[1:]], np.int64)
        ends = np.cumsum(sizes[ids[0]])
        stops = np.searchsorted(ends, np.cumsum(length[spaced])) + 1
        order = np.argsort(np.concatenate((np.flatnonzero(spaced), np.flatnonzero(~spaced))))
        where = np.concatenate(([0], stops, len(ids[0]) + np.cumsum(counts))) * 4
        return ragged(where, np.concatenate(ids).view(np.uint8)).take(pa.array(order))

    parts = TextParts(resolve, pa.binary(), specials, CACHE_BYTES)

    def encode(column: pa.Array):
        for part in slices(column, SLICE_BYTES):
            values, first = parts.of(part)
            begin, data = flat(values)
            yield ragged(begin[first], data)

    return encode


@tidy
def _shards(batches, path: str, end_id: int):
    """A task's documents, which come in id order, as shards."""
    encode, end = _library(path), np.array([end_id], "<u4").tobytes()
    part = TaskContext.get().partitionId()
    keys, nulls, payload, have, before, number = [], [], [], 0, 0, 0

    def row():
        ids, none = np.array(keys, np.int64), np.array(nulls, bool)
        hashes = key_hashes(ids, none, _turns(ids, none))
        pilots, slots = build_index(hashes)
        lengths = np.array([len(p) // 4 for p in payload], np.int64)
        starts = np.cumsum(lengths) - lengths
        by_slot = np.empty(len(slots), np.int64)
        by_slot[slots] = np.arange(len(slots))
        named = ids[~none]
        bounds = (int(named[0]), int(named[-1])) if len(named) else (None, None)
        values = (part, number, before, have, *bounds, ids[by_slot].tobytes(), np.packbits(none[by_slot]).tobytes(), pilots.tobytes(), (hashes[by_slot] & U(0xFFFFFFFF)).astype(np.uint32).tobytes(), starts[by_slot].tobytes(), lengths[by_slot].tobytes(), b"".join(payload))
        kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 4, *[pa.binary()] * 7]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], [c.split()[0] for c in SHARDS.split(", ")])

    for batch in batches:
        at = 0
        names = batch.column(0).to_pylist()
        for texts in encode(batch.column(1)):
            begin, data = flat(texts)
            view, begin = memoryview(data), begin.tolist()
            for a, b in zip(begin[:-1], begin[1:], strict=True):
                name = names[at]
                at += 1
                keys.append(0 if name is None else name)
                nulls.append(name is None)
                payload.append(bytes(view[a:b]) + end)
                have += len(payload[-1]) // 4
                if have >= SHARD_IDS or len(keys) >= SHARD_DOCS:
                    yield row()
                    keys, nulls, payload, before, have, number = [], [], [], before + have, 0, number + 1
    if keys:
        yield row()


def write_index(docs: DataFrame, path: str, out: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> None:
    """Encode every text with the tokenizers library and write the file set to out, in ascending id order.

    path is a JSON tokenizer file that each task can open. Null texts count as empty: they hold end_id alone. Null ids
    come last; rows of equal id lie side by side, ordered by a hash of their text, so even many of them are shared out
    among tasks. Ids are whole numbers. An empty table gives an empty file set. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = F.col("id").asc_nulls_last(), F.xxhash64("text")
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    ordered.mapInArrow(partial(_shards, path=path, end_id=end_id), SHARDS).write.mode("errorifexists").option("compression", "zstd").parquet(out)


def _in_order(shard: dict) -> tuple[np.ndarray, np.ndarray]:
    """The keys of a shard as its documents lie in the payload, and which of them are null."""
    order = np.argsort(np.frombuffer(shard["starts"], np.int64))
    keys = np.frombuffer(shard["keys"], np.int64)
    return keys[order], np.unpackbits(np.frombuffer(shard["nulls"], np.uint8))[: len(keys)].astype(bool)[order]


@tidy
def _read(batches, base):
    for batch in batches:
        for shard in batch.to_pylist():
            keys, none = _in_order(shard)
            starts, lengths, known = look_up(shard, key_hashes(keys, none, _turns(keys, none)))
            if not known.all():
                raise ValueError("a shard's index doesn't know its own keys")
            payload, first = memoryview(shard["payload"]), base[shard["part"]] + shard["before"]
            sums = [zlib.crc32(payload[4 * s : 4 * (s + n)]) for s, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64(), mask=none), pa.array(first + starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())], ["id", "start", "n_tokens", "ids_crc32"]
            )


def read_index(spark: SparkSession, out: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document in a file set, each through its shard's index."""
    shards = spark.read.schema(SHARDS).parquet(out)
    totals = shards.groupBy("part").agg(F.sum("ids").alias("ids")).orderBy("part").collect()  # a row for each task that wrote
    base, have = {}, 0
    for row in totals:
        base[row.part] = have
        have += row.ids
    return shards.mapInArrow(partial(_read, base=base), "id long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", id_col)


def _find(batches, wanted: np.ndarray):
    for batch in batches:
        for shard in batch.to_pylist():
            near, turn = wanted[(wanted >= shard["low"]) & (wanted <= shard["high"])], 0
            while len(near):
                hashes = key_hashes(near, np.zeros(len(near), bool), np.full(len(near), turn))
                starts, lengths, known = look_up(shard, hashes, near)
                near, turn = near[known], turn + 1
                ids = [shard["payload"][4 * a : 4 * (a + n)] for a, n in zip(starts[known].tolist(), lengths[known].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(near), pa.array(ids, pa.binary())], ["id", "ids"])


def fetch(spark: SparkSession, out: str, ids: list[int]) -> DataFrame:
    """(id, ids) for every document of the keys asked for; a key that no document has gives no row.

    Only the shards whose range of keys holds a wanted one are read; there a look-up reads one pilot and one slot for
    each document of the key and compares the key itself.
    """
    wanted = np.unique(np.array(ids, np.int64))
    shards = spark.read.schema(SHARDS).parquet(out)
    near = F.lit(False)
    for run in np.array_split(wanted, min(RANGES, len(wanted))) if len(wanted) else ():
        near |= (F.col("high") >= int(run[0])) & (F.col("low") <= int(run[-1]))
    return shards.where(near).mapInArrow(partial(_find, wanted=wanted), "id long, ids binary")


def encode_and_read(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """write_index() to a new folder beside the checkpoints, then read_index() of it."""
    spark = docs.sparkSession
    out = f"{checkpoint_dir(spark).rstrip('/')}/token-index-{uuid.uuid4().hex}"
    write_index(docs, path, out, id_col, text_col, end_id)
    return read_index(spark, out, id_col)
