"""Token counts by the whole-token shortcut.

Offline, once: each vocabulary string that is one pre-token and that the merges lead back to its own single token is
proved whole. In the tasks, pre-tokens among these count one without merging, and only the rest are merged.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.bpe import PIECES, SLICE_BYTES, TextParts, json_merges, pieces_of
from geoloom.llm.textvec import slices, tidy

LIMIT = 1024


def whole_tokens(path: str) -> frozenset[bytes]:
    """The strings of the vocabulary, as bytes, that encode alone as one token, each proved by its merges."""
    merges = json_merges(path)
    alone = []
    for token in merges.vocabulary:
        try:
            text = token.decode("utf-8")
        except UnicodeDecodeError:
            continue
        if PIECES.findall(text) == [text]:
            alone.append(token)
    ids, begin = merges.merge(pa.array(alone, pa.binary()))
    one, first = (np.diff(begin) == 1).tolist(), ids[begin[:-1]].tolist()
    return frozenset(token for token, single, i in zip(alone, one, first, strict=True) if single and i == merges.vocabulary[token])


@tidy
def _count(batches, path: str, whole, limit: int):
    merges, known = json_merges(path), pa.array(sorted(whole.value), pa.binary())

    def resolve(parts: pa.Array) -> pa.Array:
        pieces, of, first = pieces_of(parts)
        rest = pc.invert(pc.is_in(pieces, value_set=known))
        counts = np.ones(len(pieces), np.int64)
        counts[rest.to_numpy(zero_copy_only=False)] = np.diff(merges.merge(pieces.filter(rest))[1])
        sums = np.append(0, np.cumsum(counts[of]))
        out = sums[first[1:]] - sums[first[:-1]]
        return pc.if_else(pc.is_in(parts, value_set=pa.array([*merges.specials], pa.string())), 1, pa.array(out))

    values = TextParts(resolve, pa.int64(), merges.specials)
    for batch in batches:
        at = 0
        for part in slices(batch.column(1), SLICE_BYTES):
            each, first = values.of(part)
            sums = np.append(0, np.cumsum(each.to_numpy()))
            counts = sums[first[1:]] - sums[first[:-1]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, part.rows), pa.array(np.diff(part.begin).astype(np.int64)), pa.array(counts), pa.array(counts > limit)], ["id", "n_bytes", "n_tokens", "over_limit"]
            )
            at += part.rows


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row of docs, counted as the tokenizers library counts by default.

    path is a byte-level BPE JSON file that each task can open. Null texts count as empty (0 tokens). The file's
    special tokens count one where their strings stand in a text. Null ids, repeated rows and any length pass; other
    columns are not read. An empty table gives an empty result.
    """
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))  # no larger than the vocabulary
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(partial(_count, path=path, whole=whole, limit=limit), f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
