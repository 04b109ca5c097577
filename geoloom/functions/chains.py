"""Links of a task's own rows followed at once, as numpy helpers for mapInArrow: what is left for rounds of joins is between tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Rows that a task follows at once.
ROWS = 1_000_000


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= ROWS:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks()


def in_chunks(work: Callable[[pa.Table], pa.Table]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """work on tables of about ROWS rows, as a function for mapInArrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches):
            yield from work(table).to_batches(max_chunksize=65536)

    return run


def least_reached(n: int, here: np.ndarray, there: np.ndarray) -> np.ndarray:
    """The least of n nodes that each reaches by links."""
    name = np.arange(n)
    while True:
        least = name.copy()
        both = np.minimum(name[here], name[there])
        for side in (here, there, name[here], name[there]):
            np.minimum.at(least, side, both)
        least = least[least]
        if (least == name).all():
            return name
        name = least


def stars(table: pa.Table) -> pa.Table:
    """Edges (u, v) that link the same nodes: from each to the least that the table's edges reach."""
    u, v = (table[c].to_numpy() for c in "uv")
    node, place = np.unique(np.concatenate((u, v)), return_inverse=True)
    here, there = np.split(place, 2)
    least = node[least_reached(len(node), here, there)]
    own = node != least
    return pa.table({"u": node[own], "v": least[own]})


def hopped(table: pa.Table) -> pa.Table:
    """Rows (id, nxt, steps, least, off) of outline.chained() that lead as far as the table's own rows do."""
    ids, nxt, steps, off = (table[c].to_numpy().copy() for c in ("id", "nxt", "steps", "off"))
    best = table["least"].combine_chunks()
    n = len(ids)
    order = np.argsort(ids)
    to = order[np.minimum(np.searchsorted(ids, nxt, sorter=order), n - 1)]
    to[ids[to] != nxt] = -1  # where nxt is no row of this table
    x, y, name = (best.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y", "id"))
    by_point = np.lexsort((name, y, x))
    new = np.ones(n, bool)
    new[1:] = name[by_point][1:] != name[by_point][:-1]
    rank = np.empty(n, np.int64)  # equal where the least edge is the same
    rank[by_point] = np.cumsum(new) - 1
    by_point = by_point[new]
    for _ in range(n.bit_length()):
        own = np.flatnonzero(to >= 0)
        if not len(own):
            break
        ahead = to[own]
        moved = rank[ahead] < rank[own]
        off[own] = np.where(moved, steps[own] + off[ahead], off[own])
        rank[own] = np.where(moved, rank[ahead], rank[own])
        steps[own], nxt[own], to[own] = steps[own] + steps[ahead], nxt[ahead], to[ahead]
    return pa.table({"id": ids, "nxt": nxt, "steps": steps, "least": best.take(pa.array(by_point[rank])), "off": off})
