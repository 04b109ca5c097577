"""Files of other programs: what is written comes back, in several parts."""

import sqlite3
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.functions import wkb
from geoloom.operators import enrich, raster, tilesets
from geoloom.sources import connectors, geopackage, tables, tiff

POLYGONS = "array<array<array<struct<x:double,y:double>>>>"
BOX = [(0.0, 0.0), (4.0, 0.0), (4.0, 3.0), (0.0, 0.0)]
HOLE = [(1.0, 0.5), (2.0, 1.0), (1.5, 0.5), (1.0, 0.5)]
SHAPES = [(1, [[BOX]]), (2, [[BOX, HOLE], [HOLE]]), (3, []), (4, None)]


def plain(polygons):
    return None if polygons is None else [[[tuple(p) for p in r] for r in polygon] for polygon in polygons]


def test_well_known_binary_comes_back(spark):
    df = spark.createDataFrame(SHAPES, f"id int, p {POLYGONS}").select("id", wkb.to_wkb("p").alias("b"))
    assert {r.id: plain(r.p) for r in df.select("id", wkb.from_wkb("b").alias("p")).collect()} == dict(SHAPES)


def test_well_known_binary_of_other_programs():
    ring = np.array(BOX)
    big = struct.pack(">BIII", 0, 3, 1, 4) + ring.astype(">f8").tobytes()
    high = np.column_stack([ring, [7.0, 7.0, 7.0, 7.0]])
    for data in (big, struct.pack("<BIII", 1, 1003, 1, 4) + high.astype("<f8").tobytes(), struct.pack("<BIII", 1, 0x80000003, 1, 4) + high.astype("<f8").tobytes(), struct.pack("<BIIII", 1, 0x20000003, 2056, 1, 4) + ring.astype("<f8").tobytes()):
        assert plain(wkb.polygons_of(data)) == [[BOX]]
    point, line = struct.pack("<BIdd", 1, 1, 1.0, 2.0), struct.pack("<BII", 1, 2, 4) + ring.astype("<f8").tobytes()
    assert wkb.polygons_of(point) is None and wkb.polygons_of(line) is None and wkb.polygons_of(None) is None
    assert plain(wkb.polygons_of(struct.pack("<BII", 1, 7, 3) + point + big + line)) == [[BOX]]
    header = struct.pack("<2sBBi4d", b"GP", 0, 1 | 1 << 1, 2056, 0, 4, 0, 3)
    assert plain(wkb.packaged_polygons(header + big)) == [[BOX]]


def test_geopackage_comes_back_in_ranges(spark, tmp_path):
    geopackage.register(spark)
    rows = spark.range(1000).select(
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("id"), (F.col("id") / 4).alias('odd "name"'), F.concat(F.lit("n"), "id").alias("name"), (F.col("id") % 2 == 0).alias("even"),
        F.when(F.col("id") % 5 > 0, F.array(F.array(F.array(*(F.struct((F.col("id") + x).alias("x"), F.lit(y).alias("y")) for x, y in BOX))))).alias("geom"),
    ).repartition(3)
    path = str(tmp_path / "a b")
    rows.write.format("geopackage").mode("overwrite").option("srs", 2056).save(path)
    back = spark.read.format("geopackage").option("rows", 100).load(path)
    assert back.rdd.getNumPartitions() >= 10
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(back) == key(rows) and back.columns == rows.columns
    rows.limit(5).write.format("geopackage").mode("append").save(path)
    assert spark.read.format("geopackage").load(path).count() == 1005
    rows.limit(5).write.format("geopackage").mode("overwrite").save(path)
    assert spark.read.format("geopackage").load(path).count() == 5
    rows.where("false").write.format("geopackage").mode("overwrite").save(path)
    empty = spark.read.format("geopackage").load(path)
    assert empty.count() == 0 and empty.columns == rows.columns
    assert [p.name for p in (tmp_path / "a b").iterdir() if p.name.startswith(".")] == []


def test_geopackage_tables_and_faults(spark, tmp_path):
    geopackage.register(spark)
    path = str(tmp_path / "two.gpkg")
    db = sqlite3.connect(path)
    db.executescript(geopackage.TABLES + "CREATE TABLE a (fid INTEGER PRIMARY KEY, shape BLOB, day DATE, n MEDIUMINT); CREATE TABLE b (fid INTEGER PRIMARY KEY, shape BLOB);")
    db.executemany("INSERT INTO gpkg_geometry_columns VALUES (?, 'shape', 'GEOMETRY', 4326, 0, 0)", [("a",), ("b",)])
    point = struct.pack("<2sBBi", b"GP", 0, 1, 4326) + struct.pack("<BIdd", 1, 1, 1.0, 2.0)
    db.executemany("INSERT INTO a VALUES (?, ?, ?, ?)", [(5, point, "2020-01-02", 3), (10**12, None, None, None)])
    db.commit()
    db.close()
    found = spark.read.format("geopackage").option("table", "a").option("rows", 1).load(path)
    assert {tuple(r) for r in found.collect()} == {(5, None, "2020-01-02", 3), (10**12, None, None, None)}
    assert spark.read.format("geopackage").option("table", "b").load(path).count() == 0
    with pytest.raises(Exception, match="option table"):
        spark.read.format("geopackage").load(path)
    with pytest.raises(ValueError, match="mounted"):
        geopackage.local("s3://bucket/x.gpkg")


def built(pixels, order="<", tile=None, apart=False, predictor=False, big=False, palette=None):
    """A TIFF file as other programs may write it: big-endian, in tiles, with bands apart, differences, or 8-byte offsets."""
    height, width, bands = pixels.shape
    rows, columns = tile or (3, width)
    blocks = []
    for plane in np.moveaxis(pixels, 2, 0)[..., None] if apart else [pixels]:
        for top in range(0, height, rows):
            for left in range(0, width, columns):
                block = plane[top : top + rows, left : left + columns]
                if tile:
                    block = np.pad(block, ((0, rows - block.shape[0]), (0, columns - block.shape[1]), (0, 0)))
                if predictor:
                    block = np.diff(block, axis=1, prepend=np.zeros_like(block[:, :1]))
                blocks.append(zlib.compress(block.astype(pixels.dtype.newbyteorder(order)).tobytes()))
    at, sizes = (324, 325) if tile else (273, 279)
    tags = {256: [width], 257: [height], 258: [8 * pixels.dtype.itemsize] * bands, 259: [8], 277: [bands], 284: [2 if apart else 1], 317: [2 if predictor else 1], 339: [{"u": 1, "i": 2, "f": 3}[pixels.dtype.kind]] * bands}
    tags |= {at: [0] * len(blocks), sizes: [len(b) for b in blocks]} | ({322: [columns], 323: [rows]} if tile else {278: [rows]}) | ({320: palette} if palette else {})
    word, head = ("Q", 16) if big else ("I", 8)
    width_of = 8 if big else 4
    start = head + (8 if big else 2) + len(tags) * (20 if big else 12) + width_of
    inline = lambda values: len(values) * width_of <= width_of
    data = start + sum(0 if inline(v) else len(v) * width_of for v in tags.values())
    tags[at] = [data + sum(map(len, blocks[:k])) for k in range(len(blocks))]
    entries = rest = b""
    for tag, values in sorted(tags.items()):
        raw = struct.pack(f"{order}{len(values)}{word}", *values)
        entries += struct.pack(order + "HH" + word, tag, 16 if big else 4, len(values)) + (raw if inline(values) else struct.pack(order + word, start + len(rest)))
        rest += b"" if inline(values) else raw
    first = struct.pack(order + "HHHQ", 43, 8, 0, 16) if big else struct.pack(order + "HI", 42, 8)
    return {"<": b"II", ">": b"MM"}[order] + first + struct.pack(order + ("Q" if big else "H"), len(tags)) + entries + bytes(width_of) + rest + b"".join(blocks)


def whole(spark, paths, **how):
    """The pixels of each band of each file, put together from its blocks."""
    found = {}
    for r in tiff.tiff_blocks(spark.createDataFrame([(p,) for p in paths], "path string"), tasks=8, **how).collect():
        for k, row in enumerate(r.rows):
            for x, v in enumerate(row):
                assert found.setdefault((r.path, r.band), {}).setdefault((r.top + k, r.left + x), v) == v
    return found


def test_tiff_files_of_other_programs(spark, tmp_path):
    rng = np.random.default_rng(3)
    files = {}
    for k, how in enumerate(({}, {"order": ">"}, {"tile": (16, 16)}, {"tile": (16, 32), "apart": True, "order": ">"}, {"predictor": True}, {"tile": (16, 16), "predictor": True, "apart": True}, {"big": True})):
        for kind in ("uint8", "int16", "float32")[: 2 if "predictor" in how else 3]:
            pixels = rng.integers(0, 100, (37, 50, 3)).astype(kind)
            path = tmp_path / f"{k}-{kind}.tif"
            path.write_bytes(built(pixels, **how))
            files[str(path)] = pixels
    found = whole(spark, files, at_once=2)
    assert len(found) == 3 * len(files)
    for (path, band), cells in found.items():
        assert cells == {(y, x): float(v) for (y, x), v in np.ndenumerate(files[path][:, :, band - 1])}, path


def test_tiffs_come_back_with_their_place(spark, tmp_path):
    rows = [("a/1.tif", [[1, 2, 3], [4, 5, None]], 10.0, 50.0, 0.5, 0.25), ("2.tif", [[7]], None, None, None, None), (None, [[1]], 1.0, 1.0, 1.0, 1.0), ("3.tif", None, 1.0, 1.0, 1.0, 1.0), ("4.tif", [[]], 1.0, 1.0, 1.0, 1.0)]
    images = spark.createDataFrame(rows, "img_file string, rows array<array<int>>, x double, y double, dx double, dy double")
    paths = tiff.write_tiffs(images, f"file://{tmp_path}", place=["x", "y", "dx", "dy"], epsg=2056, nodata=255, strip=1)
    assert sorted(r.path for r in paths.collect()) == [f"{tmp_path}/2.tif", f"{tmp_path}/a/1.tif"]
    (tmp_path / "2.tfw").write_text("2.0\n0.0\n0.0\n-2.0\n101.0\n199.0\n")
    info = {r.path: tuple(r)[1:] for r in tiff.tiff_info(paths).collect()}
    assert info[f"{tmp_path}/a/1.tif"] == (3, 2, 1, 2056, 10.0, 50.0, 0.5, 0.25, 255.0, None, 2)
    assert info[f"{tmp_path}/2.tif"] == (1, 1, 1, 2056, 100.0, 200.0, 2.0, 2.0, 255.0, None, 1)
    found = whole(spark, [f"{tmp_path}/a/1.tif"])
    assert found == {(f"{tmp_path}/a/1.tif", 1): {(0, 0): 1.0, (0, 1): 2.0, (0, 2): 3.0, (1, 0): 4.0, (1, 1): 5.0, (1, 2): 255.0}}
    assert tiff.tiff_info(paths.where("false")).count() == 0 and tiff.tiff_blocks(paths.where("false")).count() == 0


def test_tiff_palettes_and_faults(spark, tmp_path):
    colours = [256 * (k // 8) for k in range(3 * 256)]
    path = tmp_path / "p.tif"
    path.write_bytes(built(np.array([[[3], [255]]], "uint8"), palette=colours))
    df = tiff.tiff_info(spark.createDataFrame([(str(path),)], "path string"))
    painted = df.select(raster.apply_palette(F.array(F.lit(3), F.lit(255), F.lit(256)), raster.clear_nodata(F.col("palette"))).alias("c")).first().c
    assert painted == [[0, 32, 64, 255], [0, 0, 0, 0], None]
    (tmp_path / "x.tif").write_bytes(b"no image")
    with pytest.raises(Exception, match="not a TIFF file"):
        tiff.tiff_info(spark.createDataFrame([(str(tmp_path / "x.tif"),)], "path string")).collect()


def test_boxes_find_files_by_the_end_of_their_path(spark):
    plans = ["ABCDEF12", "ABCDEF", "ABC", "", None, "A_CDEF_1"]
    boxes = spark.createDataFrame([(str(k), p) for k, p in enumerate(plans)] + [("36", "ABCDEF12"), ("x", "ABCDEF12"), (None, "ABCDEF12")], "Num_box string, Num_plan string")
    paths = ["/p/ABCDEF_12.tif", "/p/1_ABCDEF_12.tif", "/p/ABCDEF_12.tif", "/p/ABCDEF_.tif", "/p/xABC_.tif", "/p/A_CDEF__1.tif", "/p/ABCDEF_12.png", None, "_.tif"]
    found = enrich.boxes_in_files(boxes, spark.createDataFrame([(p,) for p in paths], "path string")).select("Num_box", "tilepath")
    want = {(str(k), p) for k, plan in enumerate(plans) if plan is not None for p in paths if p and p.endswith(f"{plan[:6]}_{plan[6:]}.tif")}
    assert sorted(map(tuple, found.collect())) == sorted(want) and len(want) > 6


def test_metadata_of_a_folder(spark, tmp_path):
    (tmp_path / "18_1_2.tif").write_bytes(tiff.encoded(np.zeros((4, 6, 3), "uint8"), (0.0, 0.0, 1.0, 1.0), 3857))
    tasks = spark.createDataFrame([("all/18_1_2.tif", 0, 0, 5, 7, 2020), ("all/18_9_9.tif", 0, 0, 5, 7, 2020)], "img_file string, x0 int, y0 int, x1 int, y1 int, year_tile int")
    found = connectors.folder_metadata(connectors.folder_files(tasks, spark.createDataFrame([(f"{tmp_path}/18_1_2.tif",)], "path string")), ("x0", "y0", "x1", "y1"), year="year_tile")
    assert [r.asDict(True) for r in found.collect()] == [{"img_file": "all/18_1_2.tif", "width": 6, "height": 4, "year": 2020, "extent": {"xmin": 0.0, "ymin": 0.0, "xmax": 5.0, "ymax": 7.0, "spatialReference": {"latestWkid": "3857"}}}]
    found.select("width", "height", "year", "extent").coalesce(1).write.json(str(tmp_path / "json_out"))
    (tmp_path / "json_out" / next(p for p in (tmp_path / "json_out").iterdir() if p.suffix == ".json").name).rename(tmp_path / "18_1_2.json")
    back = tables.read_image_metadata(spark, f"{tmp_path}/18_1_2.json").first()
    assert back.img_file.endswith(f"{tmp_path}/18_1_2.tif") and (back.width, back.extent.xmax, back.extent.spatialReference.latestWkid) == (6, 5.0, "3857")


def test_categories_without_labels(spark):
    kind = "CATEGORY string, SUPERCATEGORY string"
    labels = spark.createDataFrame([("b", "t"), ("a", "t"), ("a", "t"), (None, "t")], kind)
    none, known = spark.createDataFrame([], kind), "name string, supercategory string"
    configured, saved = spark.createDataFrame([("z", "s")], known), spark.createDataFrame([("y", "s"), ("x", "s")], known)
    rows = lambda *a: sorted(map(tuple, tilesets.known_categories(*a).collect()))
    assert rows(labels, configured, saved) == [(1, "a", "t"), (2, "b", "t")]
    assert rows(none, configured, saved) == [(1, "z", "s")]
    assert rows(none, None, saved) == [(1, "y", "s"), (2, "x", "s")]
    assert rows(none) == [(1, "foo", "bar ")]
