"""Small groups of boxes united, parted into pieces and outlined, many groups at once, as numpy helpers behind Arrow-batched UDFs.

A group is an array of structs. operators/outline.py says what is kept, what a piece is, and how rings run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from geoloom.functions.chains import least_reached
from geoloom.functions.trapezoids import _lengths, _ranked, _spread

#: What is united at once: strips times places along them.
WORK = 4_000_000
SIDES = ("p_x0", "p_y0", "p_x1", "p_y1")


def _columns(column: pa.ListArray) -> tuple[np.ndarray, list[np.ndarray], pa.Array]:
    """The group of each box of a column, its sides, and all boxes."""
    each = column.flatten()
    return np.repeat(np.arange(len(column)), _lengths(column)), [each.field(c).to_numpy(zero_copy_only=False) for c in SIDES], each


def _listed(g: np.ndarray, n: int, values: pa.Array) -> pa.ListArray:
    """Lists of values by their group of n, in order of groups."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.bincount(g, minlength=n)))), pa.int32()), values)


def united(g: np.ndarray, second: np.ndarray, sides: list[np.ndarray], table: list[bool]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(group, sides) of boxes that don't overlap and cover what table keeps (outside both sets, in the first, in the second, in both).

    Boxes are cut into strips at all sides of their group; what is kept of neighbouring strips is one box where it is the same.
    """
    x0, y0, x1, y1 = sides
    gx, x, place = _ranked(np.concatenate((g, g)), np.concatenate((x0, x1)))
    first, last = np.split(place, 2)
    gy, y, place = _ranked(np.concatenate((g, g)), np.concatenate((y0, y1)))
    low, high = np.split(place, 2)
    heights = np.searchsorted(gy, gx, "right") - np.searchsorted(gy, gx)
    if heights.sum() > 4 * WORK:  # by one large group, as _slices() gives them
        at = x[gx == np.argmax(np.bincount(gx, heights))]
        if len(at) > 2:
            return _halved(g, second, sides, table, at[len(at) // 2])
    base = np.cumsum(heights) - heights - np.searchsorted(gy, gx)  # of a strip: where its place for y[0] would lie
    strip, row = _spread(first, last - first)
    size = int(heights.sum())
    inside = []
    for own in (~second[row], second[row]):
        turns = np.zeros(size + 1, np.int64)
        k, r = strip[own], row[own]
        np.add.at(turns, base[k] + low[r], 1)
        np.add.at(turns, base[k] + high[r], -1)
        inside.append(np.cumsum(turns) > 0)
    keep = np.array(table, bool)[inside[0] + 2 * inside[1]]
    keep[np.cumsum(heights) - 1] = False  # above the highest side of a strip
    keep[-1] = False
    change = np.diff(np.concatenate(([0], keep.astype(np.int8))))
    begin, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    strip = np.searchsorted(np.cumsum(heights), begin, "right")
    low, high = begin - base[strip], end - base[strip]
    order = np.lexsort((strip, high, low))  # places of y tell groups apart
    strip, low, high = strip[order], low[order], high[order]
    new = np.ones(len(strip), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1]) | (strip[1:] != strip[:-1] + 1)
    a, b = np.flatnonzero(new), np.flatnonzero(np.append(new[1:], np.ones(min(1, len(new)), bool)))
    out = [x[strip[a]], y[low[a]], x[np.minimum(strip[b] + 1, len(x) - 1)], y[high[a]]] if len(a) else [np.zeros(0)] * 4
    return gy[low[a]], out


def _halved(g: np.ndarray, second: np.ndarray, sides: list[np.ndarray], table: list[bool], at: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """united() of the two halves at an x."""
    found = []
    for k, of in ((0, np.maximum), (2, np.minimum)):
        own = np.flatnonzero(sides[2] > at if k == 0 else sides[0] < at)
        half = [s[own] for s in sides]
        half[k] = of(half[k], at)
        found.append(united(g[own], second[own], half, table))
    (a, left), (b, right) = found
    return np.concatenate((a, b)), [np.concatenate(s) for s in zip(left, right, strict=True)]


def pieces(g: np.ndarray, sides: list[np.ndarray]) -> np.ndarray:
    """The piece of each of boxes that don't overlap within their group, from 0 in each group by its least point."""
    x0, y0, x1, y1 = sides
    n = len(g)
    here, there = [], []
    for at0, at1, low, high in ((x0, x1, y0, y1), (y0, y1, x0, x1)):
        # Boxes that end at a line and those that begin there, in order along it.
        _, _, line = _ranked(np.concatenate((g, g)), np.concatenate((at0, at1)))
        box, begins = np.tile(np.arange(n), 2), np.repeat([1, 0], n)
        along = low[box]
        order = np.lexsort((along, line))
        box, begins, along, line = box[order], begins[order], along[order], line[order]
        for kind in (0, 1):
            # The last of the other kind so far; of two that begin at one place the later one finds the earlier.
            last = np.maximum.accumulate(np.where(begins != kind, np.arange(2 * n), -1))
            mine = np.flatnonzero((begins == kind) & (last >= 0))
            other = last[mine]
            met = (line[mine] == line[other]) & (high[box[other]] > along[mine])
            here.append(box[mine[met]])
            there.append(box[other[met]])
    return _numbered(g, least_reached(n, np.concatenate(here), np.concatenate(there)), x0, y0)


def _numbered(g: np.ndarray, name: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Names counted from 0 in each group by the least (x, y) of each."""
    order = np.lexsort((y, x, g))
    _, first, inverse = np.unique(name[order], return_index=True, return_inverse=True)
    turn = np.argsort(first)  # in the order of their least points
    rank = np.empty(len(turn), np.int64)
    rank[turn] = np.arange(len(turn))
    owner = g[order][first[turn]]
    start = np.searchsorted(owner, owner)
    out = np.empty(len(g), np.int64)
    out[order] = (np.arange(len(turn)) - start)[rank[inverse]]
    return out


def edges(g: np.ndarray, sides: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """(group, x, y, u, v): the directed edges around boxes that don't overlap, inside on the left, as long as they can be."""
    x0, y0, x1, y1 = sides
    found = []
    for flat, lines in ((True, ((y0, x0, x1, 1), (y1, x0, x1, -1))), (False, ((x1, y0, y1, 1), (x0, y0, y1, -1)))):
        at = np.concatenate([line for line, *_ in lines for _ in range(2)])
        pos = np.concatenate([p for _, a, b, _ in lines for p in (a, b)])
        d = np.concatenate([np.full(len(g), s * t) for *_, s in lines for t in (1, -1)])
        group = np.tile(g, 4)
        order = np.lexsort((pos, at, group))
        group, at, pos, d = group[order], at[order], pos[order], d[order]
        new = np.ones(len(g) * 4, bool)
        new[1:] = (group[1:] != group[:-1]) | (at[1:] != at[:-1]) | (pos[1:] != pos[:-1])
        first = np.flatnonzero(new)
        d = np.add.reduceat(d, first) if len(first) else d
        first, d = first[d != 0], d[d != 0]
        group, at, pos, net = group[first], at[first], pos[first], np.cumsum(d)
        k = np.flatnonzero(net[:-1])
        p, q = np.where(net[k] > 0, pos[k], pos[k + 1]), np.where(net[k] > 0, pos[k + 1], pos[k])
        found.append((group[k], p, at[k], q, at[k]) if flat else (group[k], at[k], p, at[k], q))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def rings(g: np.ndarray, x: np.ndarray, y: np.ndarray, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ring, place) of directed edges: the number of the ring's edge from its least point, and the place from there."""
    n = len(g)
    order = np.lexsort((y, x, g))
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    new = np.ones(n, bool)
    new[1:] = (g[order][1:] != g[order][:-1]) | (x[order][1:] != x[order][:-1]) | (y[order][1:] != y[order][:-1])
    point, first = np.cumsum(new) - 1, np.flatnonzero(new)
    degree = np.diff(np.append(first, n))
    # Each point that an edge ends in also begins one.
    ends = np.lexsort((v, u, g))
    again = np.ones(n, bool)
    again[1:] = (g[ends][1:] != g[ends][:-1]) | (u[ends][1:] != u[ends][:-1]) | (v[ends][1:] != v[ends][:-1])
    end = np.empty(n, np.int64)
    end[ends] = np.cumsum(again) - 1
    one, two = order[first[end]], order[first[end] + degree[end] - 1]
    left = (u - x) * (v[one] - y[one]) - (v - y) * (u[one] - x[one]) > 0

    def chained(right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        nxt = np.where((degree[end] == 1) | (left != right[end]), one, two)
        steps, least, off = np.ones(n, np.int64), rank.copy(), np.zeros(n, np.int64)
        while True:
            moved = least[nxt] < least
            off = np.where(moved, steps + off[nxt], off)
            least = np.where(moved, least[nxt], least)
            steps, nxt = steps + steps[nxt], nxt[nxt]
            if not moved.any():
                break
        size = np.bincount(least, minlength=n)[least]
        return order[least], np.where(off == 0, 0, size - off)

    ring, place = chained(np.zeros(len(first), bool))
    # Where a ring comes to a point twice it is taken apart there: an outline and a hole that touch it.
    double = degree == 2
    double[double] = ring[order[first[double]]] == ring[order[first[double] + 1]]
    return chained(double) if double.any() else (ring, place)


def _slices(n: np.ndarray):
    """(low, high): runs of groups of bounded sums of n."""
    done = np.cumsum(n) // WORK
    bounds = [0, *(np.flatnonzero(done[1:] != done[:-1]) + 1).tolist(), len(n)]
    return [(low, high) for low, high in zip(bounds[:-1], bounds[1:], strict=True) if high > low]


def unite(table: list[bool]):
    """A UDF: boxes that don't overlap and cover what table keeps of each group of boxes with second."""

    @F.arrow_udf("array<struct<p_x0:double,p_y0:double,p_x1:double,p_y1:double>>")
    def run(groups: pa.Array) -> pa.Array:
        g, sides, each = _columns(groups)
        second = each.field("second").to_numpy(zero_copy_only=False).astype(bool)
        found = []
        # A group has at most two sides of each box along each axis.
        for low, high in _slices(4 * _lengths(groups).astype(np.int64) ** 2):
            a, b = np.searchsorted(g, [low, high])
            own, out = united(g[a:b] - low, second[a:b], [s[a:b] for s in sides], table)
            order = np.argsort(own, kind="stable")
            found.append([own[order] + low, *(s[order] for s in out)])
        g, *sides = (np.concatenate(c) for c in zip(*found, strict=True)) if found else [np.zeros(0, np.int64), *[np.zeros(0)] * 4]
        return _listed(g, len(groups), pa.StructArray.from_arrays([pa.array(s) for s in sides], list(SIDES)))

    return run


def part():
    """A UDF: the boxes of each group with the number of their piece."""

    @F.arrow_udf("array<struct<p_x0:double,p_y0:double,p_x1:double,p_y1:double,part:int>>")
    def run(groups: pa.Array) -> pa.Array:
        g, sides, _ = _columns(groups)
        number = pieces(g, sides).astype(np.int32)
        return _listed(g, len(groups), pa.StructArray.from_arrays([pa.array(s) for s in (*sides, number)], [*SIDES, "part"]))

    return run


def outlined():
    """A UDF: the polygons of each group of boxes with part: the outer ring of each part, then its holes by their least points."""

    @F.arrow_udf("array<struct<part:int,polygon:array<array<struct<x:double,y:double>>>,area:double>>")
    def run(groups: pa.Array) -> pa.Array:
        g, sides, each = _columns(groups)
        key, number, piece = _ranked(g, each.field("part").to_numpy(zero_copy_only=False))
        owner, x, y, u, v = edges(piece, sides)
        ring, place = rings(owner, x, y, u, v)
        area = np.bincount(ring, x * v - u * y, len(ring))[ring] / 2
        order = np.lexsort((place, ring, y[ring], x[ring], area < 0, owner))
        owner, ring, x, y, area = owner[order], ring[order], x[order], y[order], area[order]
        new = np.ones(len(ring), bool)
        new[1:] = ring[1:] != ring[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(ring))[: len(first)]
        points, row = _spread(first, last - first + 1)
        points = np.where(points == last[row], first[row], points)  # closed
        p = pa.StructArray.from_arrays([pa.array(x[points]), pa.array(y[points])], ["x", "y"])
        polygons = _listed(owner[first], len(key), _listed(row, len(first), p))
        sums = np.bincount(owner[first], area[first], len(key))
        values = pa.StructArray.from_arrays([pa.array(number.astype(np.int32)), polygons, pa.array(sums)], ["part", "polygon", "area"])
        return _listed(key, len(groups), values)

    return run
