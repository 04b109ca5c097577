"""Polygons as well-known binary: one column of polygons, each its outer ring and its holes, of closed (x, y) points."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType

from geoloom.functions.polygons import RING_TYPE, nested, ring_column

POLYGONS_TYPE = ArrayType(ArrayType(RING_TYPE))
POINT, LINE, POLYGON, MULTIPOLYGON, COLLECTION = 1, 2, 3, 6, 7
#: Bytes of the envelope in a GeoPackage's geometry header, by its kind.
ENVELOPES = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}


def _shape(data: bytes, at: int) -> tuple[int, list[list[np.ndarray]], int]:
    """The kind of the shape at a place, its polygons, and the place behind it; heights and measures are left out."""
    order = "<" if data[at] else ">"
    whole = struct.Struct(order + "I")
    (code,) = whole.unpack_from(data, at + 1)
    at += 9 if code & 0x20000000 else 5
    kind, more = (code & 0x1FFFFFFF) % 1000, (code & 0x1FFFFFFF) // 1000
    size = 2 + (more in (1, 3) or bool(code & 0x80000000)) + (more in (2, 3) or bool(code & 0x40000000))

    def points(n: int, at: int) -> np.ndarray:
        return np.frombuffer(data, order + "f8", n * size, at).reshape(-1, size)[:, :2]

    if kind == POINT:
        return kind, [], at + 8 * size
    (n,) = whole.unpack_from(data, at)
    at, found = at + 4, []
    if kind == LINE:
        return kind, found, at + 8 * size * n
    rings = []
    for _ in range(n):
        if kind == POLYGON:
            (length,) = whole.unpack_from(data, at)
            rings.append(points(length, at + 4))
            at += 4 + 8 * size * length
        else:
            _, inner, at = _shape(data, at)
            found += inner
    return kind, found + ([rings] if rings else []), at


def polygons_of(data: bytes | None) -> list[list[np.ndarray]] | None:
    """The polygons of a shape; none for an empty one, null for a null or for points and lines."""
    if data is None:
        return None
    kind, found, _ = _shape(data, 0)
    return found if kind in (POLYGON, MULTIPOLYGON, COLLECTION) else None


def packaged_polygons(data: bytes | None) -> list[list[np.ndarray]] | None:
    """polygons_of() a GeoPackage's geometry, which has a header of its own; null for extended types."""
    if data is None or data[3] & 0x20:
        return None
    return polygons_of(data[8 + ENVELOPES[data[3] >> 1 & 7] :])


def polygons_column(found: list[list[list[np.ndarray]] | None]) -> pa.ListArray:
    """An Arrow column of polygons."""
    each = [p for polygons in found if polygons for p in polygons]
    flat = nested(ring_column([r for p in each for r in p]), [len(p) for p in each])
    return nested(flat, [None if polygons is None else len(polygons) for polygons in found])


def _polygon(rings: list[bytes]) -> bytes:
    return struct.pack("<BII", 1, POLYGON, len(rings)) + b"".join(struct.pack("<I", len(r) // 16) + r for r in rings)


def encoded(column: pa.ListArray, header: bytes = b"") -> list[bytes | None]:
    """Each value of a column of polygons as well-known binary behind a header: a polygon if it is one, else a multi-polygon."""
    lengths, flat = [], column
    for _ in range(3):
        lengths.append(pc.fill_null(pc.list_value_length(flat), 0).to_pylist())
        flat = flat.flatten()
    raw = np.stack([flat.field(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in "xy"], axis=1).astype("<f8").tobytes()
    ends = np.concatenate(([0], 16 * np.cumsum(lengths[2], dtype=np.int64))).tolist()
    rings = iter([raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)])
    each = iter([_polygon([next(rings) for _ in range(n)]) for n in lengths[1]])
    out = []
    for n, known in zip(lengths[0], column.is_valid().to_pylist(), strict=True):
        own = [next(each) for _ in range(n)]
        shape = own[0] if n == 1 else struct.pack("<BII", 1, MULTIPOLYGON, n) + b"".join(own)
        out.append(header + shape if known else None)
    return out


@F.arrow_udf(POLYGONS_TYPE)
def from_wkb(shapes: pa.Array) -> pa.Array:
    """Polygons of a binary column, as GeoParquet files hold them; null for null, points and lines."""
    return polygons_column([polygons_of(s) for s in shapes.to_pylist()])


@F.arrow_udf(BinaryType())
def to_wkb(polygons: pa.Array) -> pa.Array:
    """A column of polygons as well-known binary; null for null, an empty multi-polygon for none."""
    return pa.array(encoded(polygons), pa.binary())
