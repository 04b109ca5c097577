"""Byte-level BPE encoding and decoding by ranks, with a hierarchical-bitmap rank queue for the merges."""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.bpe import SLICE_BYTES, TextParts, flat, ragged, rank_merges
from geoloom.llm.textvec import slices, tidy


def encoder(path: str):
    """A text column -> binary arrays, one after another, of its texts' ids as little-endian unsigned 32-bit numbers."""
    parts = TextParts(rank_merges(path).resolve, pa.binary())

    def encode(column: pa.Array):
        for part in slices(column, SLICE_BYTES):
            values, first = parts.of(part)
            begin, data = flat(values)
            yield ragged(begin[first], data)

    return encode


def decoder(path: str):
    """A binary array of ids as little-endian unsigned 32-bit numbers -> the binary array of their bytes."""
    tokens = rank_merges(path).tokens

    def decode(ids: pa.Array) -> pa.Array:
        begin, data = flat(ids)
        where, out = flat(tokens.take(pa.array(data[begin[0] : begin[-1]].view("<u4"))))
        return ragged(where[(begin - begin[0]) // 4], out)

    return decode


@tidy
def _encode(batches, path: str):
    encode = encoder(path)
    for batch in batches:
        at = 0
        for ids in encode(batch.column(1)):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(ids)), ids], ["id", "ids"])
            at += len(ids)


@tidy
def _decode(batches, path: str):
    decode = decoder(path)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), decode(batch.column(1).fill_null(b""))], ["id", "bytes"])


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) for every row of docs: ids as binary of little-endian unsigned 32-bit numbers.

    Null texts count as empty and give no ids; there are no special tokens. Null ids and repeated rows are rows like
    others; other columns are not read; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(partial(_encode, path=path), f"id {kind}, ids binary").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, bytes) for every row of encoded; null ids give empty bytes."""
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(partial(_decode, path=path), f"id {kind}, bytes binary").withColumnRenamed("id", id_col)


def _digests(values: pa.Array) -> pa.Array:
    begin, data = flat(values)
    view, begin = memoryview(data), begin.tolist()
    return pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(begin[:-1], begin[1:], strict=True)], pa.string())


@tidy
def _digest(batches, path: str):
    encode_column, decode_ids = encoder(path), decoder(path)
    for batch in batches:
        at = 0
        for ids in encode_column(batch.column(1)):
            counts = pa.array(np.diff(flat(ids)[0]).astype(np.int64) // 4)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(ids)), counts, _digests(ids), _digests(decode_ids(ids))], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
            at += len(ids)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of encode() and of decode() after it, in one pass."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(partial(_digest, path=path), f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
