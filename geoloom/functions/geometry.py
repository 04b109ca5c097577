"""Measures and maps of axis-aligned boxes, rings and points as Column expressions; a box is four columns (x0, y0, x1, y1)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = Sequence[str]


def box_area(box: Box) -> Column:
    x0, y0, x1, y1 = map(F.col, box)
    return (x1 - x0) * (y1 - y0)


def scaled_box(box: Box, scale: float) -> list[Column]:
    """The four sides of a box scaled about its centre."""
    x0, y0, x1, y1 = map(F.col, box)
    cx, cy, hx, hy = (x0 + x1) / 2, (y0 + y1) / 2, (x1 - x0) / 2 * scale, (y1 - y0) / 2 * scale
    return [cx - hx, cy - hy, cx + hx, cy + hy]


def boxes_intersect(a: Box, b: Box) -> Column:
    """Shared points, touching borders included."""
    ax0, ay0, ax1, ay1, bx0, by0, bx1, by1 = map(F.col, (*a, *b))
    return (ax0 <= bx1) & (bx0 <= ax1) & (ay0 <= by1) & (by0 <= ay1)


def box_intersection(a: Box, b: Box) -> list[Column]:
    """The four sides of the common part; empty if a high side lies below its low side."""
    return [F.greatest(a[0], b[0]), F.greatest(a[1], b[1]), F.least(a[2], b[2]), F.least(a[3], b[3])]


def intersection_area(a: Box, b: Box) -> Column:
    x0, y0, x1, y1 = box_intersection(a, b)
    return F.greatest(x1 - x0, F.lit(0)) * F.greatest(y1 - y0, F.lit(0))


def box_iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 for an empty union."""
    shared = intersection_area(a, b)
    union = box_area(a) + box_area(b) - shared
    return F.when(union == 0, 0.0).otherwise(shared / union)


def ring_area(ring: Column) -> Column:
    """Area of a ring, an array of (x, y) structs, closed or not, by the shoelace sum."""
    following = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))
    terms = F.zip_with(ring, following, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)) / 2


def segment_area(segment: Column) -> Column:
    """Area of an outline given as a flat coordinate array, by the shoelace sum."""
    x, y = F.filter(segment, lambda _, k: k % 2 == 0), F.filter(segment, lambda _, k: k % 2 == 1)
    return ring_area(F.zip_with(x, y, lambda a, b: F.struct(a.alias("x"), b.alias("y"))))


def ring_centroid(ring: Column) -> Column:
    """(x, y) of a ring's centre of area; the mean of its points if it has no area."""
    following = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))
    cross = lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]
    added = lambda f: F.aggregate(F.zip_with(ring, following, f), F.lit(0.0), lambda s, t: s + t)
    twice = added(cross)
    mean = lambda c: F.aggregate(F.transform(ring, lambda p: p[c].cast("double")), F.lit(0.0), lambda s, t: s + t) / F.size(ring)
    part = lambda c: F.when(twice == 0, mean(c)).otherwise(added(lambda p, q: (p[c] + q[c]) * cross(p, q)) / (3 * twice))
    return F.struct(part("x").alias("x"), part("y").alias("y"))


def box_ring(box: Box) -> Column:
    """The closed ring of a box, from its lower left corner, against the clock."""
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in box)
    return F.array(*(F.struct(x.alias("x"), y.alias("y")) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))))


# The radius of the sphere of Web Mercator in metres.
EARTH = 6378137.0


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to metres of Web Mercator."""
    return F.radians(lon) * EARTH, F.log(F.tan(F.pi() / 4 + F.radians(lat) / 2)) * EARTH


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    """Metres of Web Mercator to degrees."""
    return F.degrees(x / EARTH), F.degrees(2 * F.atan(F.exp(y / EARTH)) - F.pi() / 2)


def to_swiss(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to metres of the Swiss grid LV95, by the published approximation (1 m within the country)."""
    # The coefficients of the approximation, in ten thousand seconds from the origin in Bern.
    a, b = (lon * 3600 - 26782.5) / 10000, (lat * 3600 - 169028.66) / 10000
    east = 2600072.37 + 211455.93 * a - 10938.51 * a * b - 0.36 * a * b * b - 44.54 * a * a * a
    north = 1200147.07 + 308807.95 * b + 3745.25 * a * a + 76.63 * b * b - 194.56 * a * a * b + 119.79 * b * b * b
    return east, north


def from_swiss(east: Column, north: Column) -> tuple[Column, Column]:
    """Metres of the Swiss grid LV95 to degrees, by the published approximation."""
    # The coefficients of the approximation, in thousand kilometres from the origin in Bern.
    y, x = (east - 2600000) / 1e6, (north - 1200000) / 1e6
    lon = 2.6779094 + 4.728982 * y + 0.791484 * y * x + 0.1306 * y * x * x - 0.0436 * y * y * y
    lat = 16.9023892 + 3.238272 * x - 0.270978 * y * y - 0.002528 * x * x - 0.0447 * y * y * x - 0.0140 * x * x * x
    return lon * 100 / 36, lat * 100 / 36


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value worked out once, however often use reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repaired_ring(ring: Column) -> Column:
    """A ring closed, against the clock and without points equal to the one before; null if no area is left."""
    apart = lambda r: F.filter(r, lambda p, k: (k == 0) | F.coalesce(p != F.get(r, k - 1), F.lit(True)))
    closed = lambda r: F.when(F.size(r) > 2, F.when(F.get(r, F.lit(0)) == F.get(r, F.size(r) - 1), r).otherwise(F.concat(r, F.slice(r, 1, 1))))
    cross = lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]
    turn = lambda r: F.aggregate(F.zip_with(r, F.concat(F.slice(r, 2, F.size(r)), F.slice(r, 1, 1)), cross), F.lit(0.0), lambda s, t: s + t)
    against = lambda r: bound(turn(r), lambda t: F.when(t > 0, r).when(t < 0, F.reverse(r)))
    return bound(ring, lambda r: bound(apart(r), lambda r: bound(closed(r), against)))


def flatten_ring(ring: Column) -> Column:
    """[x1, y1, x2, y2, ...]"""
    return F.flatten(F.transform(ring, lambda p: F.array(p["x"], p["y"])))


def segment_bbox(segment: Column) -> Column:
    """[x, y, width, height] of a flat coordinate array."""
    x, y = F.filter(segment, lambda _, i: i % 2 == 0), F.filter(segment, lambda _, i: i % 2 == 1)
    return F.array(F.array_min(x), F.array_min(y), F.array_max(x) - F.array_min(x), F.array_max(y) - F.array_min(y))


def to_pixel(x: Column, y: Column, box: Box, width: Column, height: Column) -> tuple[Column, Column]:
    """World to image coordinates; the image's y axis points down."""
    x0, y0, x1, y1 = map(F.col, box)
    return (x - x0) / (x1 - x0) * width, (y1 - y) / (y1 - y0) * height


def world_file(box: Box, width: Column, height: Column) -> Column:
    """The six lines of a world file: scales, rotations, and the centre of the upper left pixel."""
    x0, y0, x1, y1 = map(F.col, box)
    a, e = (x1 - x0) / width, -(y1 - y0) / height
    return F.concat_ws("\n", a, F.lit(0.0), F.lit(0.0), e, x0 + a / 2, y1 + e / 2)


def mercator_tile(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """Column and row of the Web Mercator tile that holds a point in degrees."""
    n = float(1 << zoom)
    s = F.sin(F.radians(lat))
    x = F.floor((lon + 180.0) / 360.0 * n)
    y = F.floor((0.5 - F.log((1 + s) / (1 - s)) / (4 * F.pi())) * n)
    return x, y


def tile_degrees(x: Column, y: Column, zoom: int) -> list[Column]:
    """West, south, east and north of a Web Mercator tile."""
    n = float(1 << zoom)
    lon = lambda c: c / n * 360.0 - 180.0
    lat = lambda c: F.degrees(2 * F.atan(F.exp(F.pi() * (1 - 2 * c / n))) - F.pi() / 2)
    return [lon(x), lat(y + 1), lon(x + 1), lat(y)]


# The base-32 alphabet of geohashes.
GEOHASH = "0123456789bcdefghjkmnpqrstuvwxyz"


def geohash(lon: Column, lat: Column, length: int = 12) -> Column:
    """Geohash of a point in degrees: bits of longitude and latitude in turn, five a character."""
    bits = 5 * length
    cell = lambda v, low, span, n: F.least(F.floor((v - low) / span * float(1 << n)), F.lit((1 << n) - 1)).cast("long")
    x, y = cell(lon, -180.0, 360.0, (bits + 1) // 2), cell(lat, -90.0, 180.0, bits // 2)

    def bit(k: int) -> Column:
        source, at = (x, (bits + 1) // 2 - 1 - k // 2) if k % 2 == 0 else (y, bits // 2 - 1 - k // 2)
        return F.shiftright(source, at).bitwiseAND(F.lit(1))

    def letter(c: int) -> Column:
        index = sum((bit(5 * c + j) * (16 >> j) for j in range(5)), F.lit(0))
        return F.substring(F.lit(GEOHASH), index.cast("int") + 1, F.lit(1))

    return F.concat(*(letter(c) for c in range(length)))


def geohash_name(ring: Column, prefix: str = "", suffix: str = "", length: int = 12) -> Column:
    """The geohash of a ring's centre of area, in degrees, between a prefix and a suffix."""
    middle = ring_centroid(ring)
    return F.concat(F.lit(prefix), geohash(middle["x"], middle["y"], length), F.lit(suffix))
