"""TIFF images as tables: what their headers say, and their pixels in blocks; and images written as such files.

Headers are read in tasks, and the strips or tiles that they list are read by ranges, so that one large image is spread over many
tasks and none holds it whole. Paths are on a disk that the driver and all executors share. A pixel's place on the map comes
from the file's own tags or else from a world file beside it.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions.polygons import nested
from geoloom.sources.geopackage import local
from geoloom.storage import stored

# The format's tags, types of values, compressions and keys.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIPS, SAMPLES, STRIP_ROWS, STRIP_BYTES, PLANES, PREDICTOR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317
COLOURS, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, SAMPLE_FORMAT, PIXEL_SCALE, TIE_POINT, GEO_KEYS, NODATA = 320, 322, 323, 324, 325, 339, 33550, 33922, 34735, 42113
TYPES = {1: "B", 2: "c", 3: "H", 4: "I", 6: "b", 7: "B", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q"}
PLAIN, DEFLATE, OLD_DEFLATE = 1, 8, 32946
PIXEL_IS, POINT, GEOGRAPHIC, PROJECTED = 1025, 2, 2048, 3072

INFO = "path string, width int, height int, bands int, epsg int, x0 double, y1 double, dx double, dy double, nodata double, palette array<array<int>>, blocks int"
BLOCKS = "path string, band int, top int, left int, rows array<array<double>>"


class Image:
    """The tags of a file's first image."""

    def __init__(self, path: str):
        self.path, self.tags = path, {}
        with open(local(path), "rb") as f:
            head = f.read(16)
            self.order = {b"II": "<", b"MM": ">"}.get(head[:2], "")
            magic = struct.unpack_from(self.order + "H", head, 2)[0] if self.order and len(head) >= 8 else 0
            if magic not in (42, 43):
                raise ValueError(f"{path} is not a TIFF file")
            at, count, entry = ("I", "H", "HHI4s") if magic == 42 else ("Q", "Q", "HHQ8s")
            f.seek(struct.unpack_from(self.order + at, head, 4 if magic == 42 else 8)[0])
            n = self._unpack(f, count)[0]
            entries = [self._unpack(f, entry) for _ in range(n)]
            for tag, kind, length, value in entries:
                if kind in TYPES:
                    size = length * struct.calcsize(TYPES[kind])
                    if size > len(value):
                        f.seek(struct.unpack(self.order + at, value)[0])
                        value = f.read(size)
                    self.tags[tag] = struct.unpack(f"{self.order}{length}{TYPES[kind]}", value[:size])
        self.width, self.height, self.bands = self.one(WIDTH), self.one(HEIGHT), self.one(SAMPLES, 1)
        tiled = TILES in self.tags
        self.block = (self.one(TILE_HEIGHT), self.one(TILE_WIDTH)) if tiled else (min(self.one(STRIP_ROWS, self.height), self.height), self.width)
        self.offsets, self.sizes = (self.tags[k] for k in ((TILES, TILE_BYTES) if tiled else (STRIPS, STRIP_BYTES)))
        self.across, self.down = -(-self.width // self.block[1]), -(-self.height // self.block[0])
        self.apart = self.one(PLANES, 1) == 2

    def _unpack(self, f, form: str) -> tuple:
        return struct.unpack(self.order + form, f.read(struct.calcsize("<" + form)))

    def one(self, tag: int, default: int | None = None) -> int:
        if tag not in self.tags and default is None:
            raise ValueError(f"{self.path} lacks the tag {tag}")
        return self.tags[tag][0] if tag in self.tags else default

    def place(self) -> tuple[float, float, float, float] | None:
        """The upper left corner and the size of a pixel; null if neither tags nor a world file tell."""
        if PIXEL_SCALE in self.tags and TIE_POINT in self.tags:
            (dx, dy), (i, j, _, x, y) = self.tags[PIXEL_SCALE][:2], self.tags[TIE_POINT][:5]
            half = 0.5 if self.keys().get(PIXEL_IS) == POINT else 0.0
            return x - (i + half) * dx, y + (j + half) * dy, dx, dy
        beside = os.path.splitext(local(self.path))[0] + ".tfw"
        if os.path.exists(beside):
            with open(beside) as f:
                dx, _, _, dy, x, y = map(float, f.read().split())
            return x - dx / 2, y - dy / 2, dx, -dy
        return None

    def keys(self) -> dict[int, int]:
        """The geographic keys whose value stands in the directory itself."""
        found = self.tags.get(GEO_KEYS, ())
        return {found[k]: found[k + 3] for k in range(4, len(found) - 3, 4) if found[k + 1] == 0}

    def info(self) -> tuple:
        text = b"".join(self.tags.get(NODATA, ())).strip(b"\0 ")
        colours = self.tags.get(COLOURS)
        n = len(colours or ()) // 3
        palette = colours and [[colours[c * n + k] >> 8 for c in range(3)] + [255] for k in range(n)]
        keys = self.keys()
        return self.path, self.width, self.height, self.bands, keys.get(PROJECTED, keys.get(GEOGRAPHIC)), *(self.place() or [None] * 4), float(text) if text else None, palette, len(self.offsets)

    def dtype(self) -> np.dtype:
        bits, kind = self.one(BITS, 1), self.one(SAMPLE_FORMAT, 1)
        if len(set(self.tags.get(BITS, ()))) > 1 or bits not in (8, 16, 32, 64) or kind not in (1, 2, 3):
            raise ValueError(f"{self.path} has samples of {self.tags.get(BITS, (1,))} bits")
        return np.dtype(f"{self.order}{'uif'[kind - 1]}{bits // 8}")

    def read(self, f, k: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """(band, top, left, pixels) of the k-th strip or tile; bands count from 1."""
        plane, at = divmod(k, self.across * self.down) if self.apart else (0, k)
        top, left = at // self.across * self.block[0], at % self.across * self.block[1]
        f.seek(self.offsets[k])
        data, how = f.read(self.sizes[k]), self.one(COMPRESSION, PLAIN)
        if how in (DEFLATE, OLD_DEFLATE):
            data = zlib.decompress(data)
        elif how != PLAIN:
            raise ValueError(f"{self.path} is compressed in a way ({how}) that isn't read here")
        samples = 1 if self.apart else self.bands
        rows = self.block[0] if TILES in self.tags else min(self.block[0], self.height - top)
        pixels = np.frombuffer(data, self.dtype(), rows * self.block[1] * samples).reshape(rows, self.block[1], samples)
        if self.one(PREDICTOR, 1) == 2:
            pixels = np.cumsum(pixels, axis=1, dtype=pixels.dtype.newbyteorder("="))
        elif self.one(PREDICTOR, 1) != 1:
            raise ValueError(f"{self.path} has a predictor that isn't read here")
        for band in range(samples):
            yield plane + band + 1, top, left, pixels[: self.height - top, : self.width - left, band]


def tiff_info(files: DataFrame, path: str = "path") -> DataFrame:
    """A row for each file: size, bands, EPSG code, upper left corner, size of a pixel, nodata, palette (red, green, blue and
    opacity, 0 to 255), and the number of its strips or tiles. What a file doesn't say is null; a file of another kind is an error."""

    def run(batches):
        for batch in batches:
            rows = [Image(p).info() for p in batch.column(0).to_pylist()]
            names = [c.split()[0] for c in INFO.split(", ")]
            types = [pa.string()] + [pa.int32()] * 4 + [pa.float64()] * 5 + [pa.list_(pa.list_(pa.int32())), pa.int32()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return files.where(F.col(path).isNotNull()).select(F.col(path).alias("path")).mapInArrow(run, INFO)


def tiff_blocks(files: DataFrame, path: str = "path", at_once: int = 16, tasks: int | None = None) -> DataFrame:
    """(path, band, top, left, rows): the pixels of each strip or tile of the files' first images, a row a band.

    Ranges of at_once blocks go to tasks by their hash, so that one file may feed all of them. A task holds one block.
    """
    tasks = tasks or 4 * files.sparkSession.sparkContext.defaultParallelism
    first = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1, F.lit(at_once))).alias("first")
    ranges = tiff_info(files, path).where("blocks > 0").select("path", first, "blocks").withColumn("last", F.least(F.col("first") + at_once, F.col("blocks"))).select("path", "first", "last")

    def run(batches):
        for batch in batches:
            for name, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                image = Image(name)
                with open(local(name), "rb") as f:
                    for k in range(low, high):
                        for band, top, left, pixels in image.read(f, k):
                            flat = pa.array(pixels.astype(np.float64).ravel())
                            rows = nested(nested(flat, [pixels.shape[1]] * len(pixels)), [len(pixels)])
                            yield pa.RecordBatch.from_arrays([pa.array([name]), *(pa.array([v], pa.int32()) for v in (band, top, left)), rows], ["path", "band", "top", "left", "rows"])

    return ranges.repartition(tasks, "path", "first").mapInArrow(run, BLOCKS)


def encoded(pixels: np.ndarray, place: Sequence[float | None] = (), epsg: int | None = None, nodata: float | None = None, strip: int = 64) -> bytes:
    """A deflated TIFF file of pixels (rows, columns, bands), in strips; place is x0, y1, dx, dy of the map."""
    height, width, bands = pixels.shape
    data = [zlib.compress(np.ascontiguousarray(pixels[k : k + strip]).astype(pixels.dtype.newbyteorder("<")).tobytes()) for k in range(0, height, strip)]
    kind = {"u": 1, "i": 2, "f": 3}[pixels.dtype.kind]
    tags = {WIDTH: ("I", [width]), HEIGHT: ("I", [height]), BITS: ("H", [8 * pixels.dtype.itemsize] * bands), COMPRESSION: ("H", [DEFLATE]), PHOTOMETRIC: ("H", [2 if bands == 3 else 1])}
    tags |= {STRIPS: ("I", [0] * len(data)), SAMPLES: ("H", [bands]), STRIP_ROWS: ("I", [strip]), STRIP_BYTES: ("I", [len(d) for d in data]), PLANES: ("H", [1]), SAMPLE_FORMAT: ("H", [kind] * bands)}
    if place and all(v is not None for v in place):
        x0, y1, dx, dy = place
        tags |= {PIXEL_SCALE: ("d", [dx, dy, 0.0]), TIE_POINT: ("d", [0.0, 0.0, 0.0, x0, y1, 0.0])}
    if epsg is not None:
        tags[GEO_KEYS] = ("H", [1, 1, 0, 2, PIXEL_IS, 0, 1, 1, GEOGRAPHIC if 4000 <= epsg < 5000 else PROJECTED, 0, 1, epsg])
    if nodata is not None:
        text = f"{nodata:g}\0".encode()
        tags[NODATA] = ("c", [text[k : k + 1] for k in range(len(text))])
    codes = {form: code for code, form in TYPES.items() if code != 7}
    long = lambda form, values: struct.calcsize(f"<{len(values)}{form}") > 4
    behind = 8 + 2 + 12 * len(tags) + 4
    start = behind + sum(struct.calcsize(f"<{len(v)}{form}") for form, v in tags.values() if long(form, v))
    tags[STRIPS] = ("I", [start + sum(map(len, data[:k])) for k in range(len(data))])
    entries, rest = b"", b""
    for tag, (form, values) in sorted(tags.items()):
        raw = struct.pack(f"<{len(values)}{form}", *values)
        entries += struct.pack("<HHI", tag, codes[form], len(values)) + (struct.pack("<I", behind + len(rest)) if len(raw) > 4 else raw.ljust(4, b"\0"))
        rest += raw if len(raw) > 4 else b""
    return struct.pack("<2sHIH", b"II", 42, 8, len(tags)) + entries + bytes(4) + rest + b"".join(data)


def write_tiffs(images: DataFrame, folder: str, name: str = "img_file", rows: str = "rows", place: Sequence[str] = (), epsg: int | None = None, nodata: float | None = None, dtype: str = "uint8", strip: int = 64) -> DataFrame:
    """(path): the files of images of one band, below folder by their name, with place the columns of x0, y1, dx and dy.

    An image without name, rows or pixels gives no file; null pixels become nodata, or 0. All rows of an image must be as long.
    A file appears whole or not at all, and a repeated task writes it again.
    """
    into, blank = local(folder), 0 if nodata is None else nodata
    wanted = images.where(F.col(name).isNotNull() & (F.size(rows) > 0) & (F.size(F.get(rows, F.lit(0))) > 0))
    wanted = wanted.select(F.col(name).alias("_name"), F.transform(rows, lambda r: F.transform(r, lambda p: F.coalesce(p.cast("double"), F.lit(float(blank))))).alias("_rows"), *(F.col(c).cast("double").alias(f"_place{k}") for k, c in enumerate(place)))

    def run(batches):
        for batch in batches:
            made = []
            for k, (own, *where) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, *range(2, batch.num_columns))), strict=True)):
                lines = batch.column(1)[k].values
                pixels = lines.flatten().to_numpy(zero_copy_only=False).reshape(len(lines), -1, 1).astype(dtype)
                path = os.path.join(into, own)
                os.makedirs(os.path.dirname(path), exist_ok=True)
                hidden = f"{path}.{uuid.uuid4().hex}"
                with open(hidden, "wb") as f:
                    f.write(encoded(pixels, where, epsg, nodata, strip))
                os.replace(hidden, path)
                made.append(path)
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], ["path"])

    return stored(wanted.mapInArrow(run, "path string"))
