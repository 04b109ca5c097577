"""Polygon measures that Column expressions can't give, as small numpy helpers behind Arrow-batched UDFs.

A polygon is one array of (x, y) structs, closed or not, without holes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

RING = "array<struct<x:double,y:double>>"
RING_TYPE = ArrayType(StructType([StructField("x", DoubleType()), StructField("y", DoubleType())]))


def clip_convex(ring: np.ndarray, window: np.ndarray) -> np.ndarray:
    """The part of a ring inside a convex, counter-clockwise window; bridges of no width may stay."""
    for p, q in zip(window, np.roll(window, -1, axis=0), strict=True):
        if not len(ring):
            break
        side = (q[0] - p[0]) * (ring[:, 1] - p[1]) - (q[1] - p[1]) * (ring[:, 0] - p[0])
        out = []
        for a, b, sa, sb in zip(ring, np.roll(ring, -1, axis=0), side, np.roll(side, -1), strict=True):
            if sa >= 0:
                out.append(a)
            if sa * sb < 0:
                out.append(a + (b - a) * sa / (sa - sb))
        ring = np.array(out).reshape(-1, 2)
    return ring


def signed_area(ring: np.ndarray) -> float:
    x, y = ring[:, 0], ring[:, 1]
    return float(x @ np.roll(y, -1) - y @ np.roll(x, -1)) / 2 if len(ring) > 2 else 0.0


def shared_area(a: np.ndarray, b: np.ndarray) -> float:
    """Area of the intersection: the fan triangles of b clip a, each with the sign of its turn."""
    total = 0.0
    for k in range(1, len(b) - 1):
        triangle = b[[0, k, k + 1]]
        turn = signed_area(triangle)
        if turn:
            total += np.sign(turn) * abs_area(clip_convex(a, triangle if turn > 0 else triangle[::-1]))
    return abs(total)


def abs_area(ring: np.ndarray) -> float:
    return abs(signed_area(ring))


def simplify(ring: np.ndarray, epsilon: float) -> np.ndarray:
    """Ramer-Douglas-Peucker on an open line of points: no dropped point lies further than epsilon from it."""
    keep, stack = np.zeros(len(ring), bool), [(0, len(ring) - 1)]
    keep[[0, -1]] = True
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        inner, base = ring[a + 1 : b] - ring[a], ring[b] - ring[a]
        length = np.hypot(*base)
        far = np.abs(base[0] * inner[:, 1] - base[1] * inner[:, 0]) / length if length else np.hypot(*inner.T)
        k = int(far.argmax())
        if far[k] > epsilon:
            keep[a + 1 + k] = True
            stack += [(a, a + 1 + k), (a + 1 + k, b)]
    return ring[keep]


def half(ring: np.ndarray, normal: tuple[float, float], least: float) -> list[np.ndarray]:
    """The parts of a simple ring where normal * point >= least, as rings of their own; a ring that only touches has none.

    Along the line, places where the ring comes in and where it goes out take turns, so the n-th of either bound the
    n-th stretch of the line inside the polygon.
    """
    side = ring @ np.array(normal) - least
    inside = side > 0  # so that parts which only an edge on the line joins come apart
    if (side >= 0).all() or not inside.any():
        return [ring] if inside.any() else []
    n, edge = len(ring), np.flatnonzero(inside != np.roll(inside, -1))
    a, b = ring[edge], ring[(edge + 1) % n]
    place = a + (b - a) * (side[edge] / (side[edge] - side[(edge + 1) % n]))[:, None]
    along = place @ np.array([-normal[1], normal[0]])
    order = np.argsort(along, kind="stable")
    comes = ~inside[edge]
    next_in = dict(zip(order[~comes[order]].tolist(), order[comes[order]].tolist(), strict=True))
    parts, todo = [], set(next_in.values())
    while todo:
        k = todo.pop()
        first, points = k, []
        while True:
            out = (k + 1) % len(edge)
            run = (edge[k] + 1 + np.arange((edge[out] - edge[k]) % n)) % n
            points += [place[k : k + 1], ring[run], place[out : out + 1]]
            k = next_in[out]
            if k == first:
                break
            todo.remove(k)
        parts.append(np.concatenate(points))
    return [p for p in parts if signed_area(p)]


def clip_box(ring: np.ndarray, x0: float, y0: float, x1: float, y1: float) -> list[np.ndarray]:
    """The parts of a simple ring inside a box."""
    parts = [ring] if signed_area(ring) else []
    for normal, least in (((1, 0), x0), ((0, 1), y0), ((-1, 0), -x1), ((0, -1), -y1)):
        parts = [q for p in parts for q in half(p, normal, least)]
    return parts


def open_rings(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(points, first, count): the flat coordinates of an Arrow column of rings, and where each lies in them without its closing point."""
    flat = column.flatten()
    xy = np.stack([flat.field(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("x", "y")], axis=1)
    count = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    first, some = np.cumsum(count) - count, np.flatnonzero(count > 1)
    count[some] -= (xy[first[some]] == xy[first[some] + count[some] - 1]).all(axis=1)
    return xy, first, count


def rings_of(column: pa.ListArray) -> list[np.ndarray | None]:
    """The rings of an Arrow column without their closing points, as views of its flat coordinates; null for null."""
    xy, first, count = open_rings(column)
    found = [xy[a : a + n] for a, n in zip(first.tolist(), count.tolist(), strict=True)]
    return [r if known else None for r, known in zip(found, column.is_valid().to_pylist(), strict=True)]


def nested(values: pa.Array, counts: list[int | None]) -> pa.ListArray:
    """values cut into lists of the given lengths; null for null."""
    ends = np.concatenate(([0], np.cumsum([c or 0 for c in counts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=pa.array([c is None for c in counts], pa.bool_()))


def ring_column(found: list[np.ndarray | None]) -> pa.ListArray:
    """An Arrow column of rings."""
    xy = np.concatenate([np.zeros((0, 2)), *(r for r in found if r is not None)])
    return nested(pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], ["x", "y"]), [None if r is None else len(r) for r in found])


@F.arrow_udf(DoubleType())
def polygon_iou(a: pa.Array, b: pa.Array) -> pa.Array:
    """Intersection over union of two polygon columns; 0 for an empty union, null for a null polygon."""

    def one(p, q):
        if p is None or q is None:
            return None
        shared = shared_area(p, q)
        union = abs_area(p) + abs_area(q) - shared
        return shared / union if union else 0.0

    return pa.array([one(p, q) for p, q in zip(rings_of(a), rings_of(b), strict=True)], pa.float64())


def spans(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of each run of count, one after the other."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _following(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The place of the next point in the ring of each point, for rings that lie one after the other."""
    after = np.arange(count.sum()) + 1
    after[start + count - 1] = start
    return after


def _with_area(points: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Whether signed_area() of each ring is not 0; it is asked only where terms almost cancel."""
    start = np.cumsum(count) - count
    a, b = points, points[_following(start, count)]
    turn, back = a[:, 0] * b[:, 1], a[:, 1] * b[:, 0]
    found = np.abs(np.add.reduceat(turn - back, start)) > 1e-9 * np.add.reduceat(np.abs(turn) + np.abs(back), start)
    for k in np.flatnonzero(~found):
        found[k] = signed_area(points[start[k] : start[k] + count[k]]) != 0
    return found


def halves(points: np.ndarray, count: np.ndarray, axis: int, sign: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """half() of many rings along one axis: (points, count, kept, many), with the places of the rings that have a part.

    Rings whose outline crosses the line more than twice may fall into several parts: these are left out and named as many.
    """
    start = np.cumsum(count) - count
    after, own = _following(start, count), np.repeat(np.arange(len(count)), count)
    side = sign * points[:, axis] - least[own]
    inside = side > 0
    crossing = inside != inside[after]
    held, crossed = (np.add.reduceat(c.astype(np.int64), start) for c in (inside, crossing))
    cut = (held > 0) & (np.minimum.reduceat(side, start) < 0)
    many, once = cut & (crossed > 2), cut & (crossed == 2)
    edge = np.flatnonzero(crossing & once[own])
    place = points[edge] + (points[after[edge]] - points[edge]) * (side[edge] / (side[edge] - side[after[edge]]))[:, None]
    comes = ~inside[edge]
    begin = np.zeros(len(count), np.int64)
    begin[once] = after[edge[comes]] - start[once]
    kept = np.flatnonzero((held > 0) & ~many)
    lead, run = once[kept].astype(np.int64), np.where(once, held, count)[kept]
    size = run + 2 * lead
    first = np.cumsum(size) - size
    turn = np.repeat(begin[kept], run) + spans(np.zeros_like(run), run)
    out = np.empty((size.sum(), 2))
    out[spans(first + lead, run)] = points[np.repeat(start[kept], run) + turn % np.repeat(count[kept], run)]
    ends = lead > 0
    out[first[ends]], out[(first + size - 1)[ends]] = place[comes], place[~comes]
    return out, size, kept, np.flatnonzero(many)


def clip_boxes(points: np.ndarray, first: np.ndarray, count: np.ndarray, boxes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(points, count, row): the parts of clip_box() for each ring and its box, by row. The rings are cut together, one by one only where
    a side crosses an outline more than twice."""
    spoilt = np.add.accumulate(np.concatenate(([0], ~np.isfinite(points).all(axis=1))))
    usual = (spoilt[first + count] == spoilt[first]) & np.isfinite(boxes).all(axis=1)
    row, single = np.flatnonzero(usual & (count > 2)), [np.flatnonzero(~usual & (count > 2) & ~np.isnan(boxes).any(axis=1))]
    now, size = points[spans(first[row], count[row])], count[row]
    if len(row):
        whole = _with_area(now, size)
        now, size, row = now[np.repeat(whole, size)], size[whole], row[whole]
    for axis, sign, k in ((0, 1, 0), (1, 1, 1), (0, -1, 2), (1, -1, 3)):
        if not len(row):
            break
        now, size, kept, many = halves(now, size, axis, sign, sign * boxes[row, k])
        single.append(row[many])
        row = row[kept]
        if len(row):
            solid = _with_area(now, size)
            now, size, row = now[np.repeat(solid, size)], size[solid], row[solid]
    found = [(r, p) for r in np.concatenate(single).tolist() for p in clip_box(points[first[r] : first[r] + count[r]], *boxes[r])]
    row = np.concatenate((row, np.array([r for r, _ in found], np.int64)))
    now, size = np.concatenate([now, *(p for _, p in found)]), np.concatenate((size, np.array([len(p) for _, p in found], np.int64)))
    order = np.argsort(row, kind="stable")
    return now[spans((np.cumsum(size) - size)[order], size[order])], size[order], row[order]


@F.arrow_udf(ArrayType(RING_TYPE))
def clipped(ring: pa.Array, x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
    """The parts of a polygon column inside a box, closed; none for a null side, null for a null polygon."""
    sides = np.stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in (x0, y0, x1, y1)], axis=1)
    xy, first, count = open_rings(ring)
    points, size, row = clip_boxes(xy, first, count, sides)
    start = np.cumsum(size) - size
    closed = spans(start, size + 1)
    closed[np.cumsum(size + 1) - 1] = start
    xy = points[closed]
    rings = nested(pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], ["x", "y"]), (size + 1).tolist())
    parts = np.bincount(row, minlength=len(count)).tolist()
    return nested(rings, [n if known else None for n, known in zip(parts, ring.is_valid().to_pylist(), strict=True)])


def simplified(epsilon: float):
    """A UDF that simplifies a polygon column's outline; rings of three points or fewer stay."""

    @F.arrow_udf(RING_TYPE)
    def run(rings: pa.Array) -> pa.Array:
        closed = [None if r is None else np.vstack([r, r[:1]]) for r in rings_of(rings)]
        return ring_column([r if r is None or len(r) <= 4 else simplify(r, epsilon) for r in closed])

    return run
