"""GeoPackage tables as a partitioned source and sink: spark.read.format("geopackage").

A path is one file or a folder of them, on a disk that the driver and all executors share. Every file is read in ranges of its
row ids and every task writes a file of its own, so no task holds a table whole.
"""

from __future__ import annotations

import contextlib
import os
import sqlite3
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import BinaryType, BooleanType, DataType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField, StructType

from geoloom.functions.wkb import POLYGONS_TYPE, encoded, packaged_polygons, polygons_column

#: Rows that a task reads, about, and rows of a batch.
ROWS, BATCH = 1 << 17, 4096
# The format's application id and version, and its names for types.
APPLICATION, VERSION = 0x47504B47, 10300
SQL_TYPES = {LongType: "INTEGER", IntegerType: "INTEGER", ShortType: "INTEGER", BooleanType: "BOOLEAN", DoubleType: "DOUBLE", FloatType: "DOUBLE", StringType: "TEXT", BinaryType: "BLOB"}
TABLES = """
CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);
CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT DEFAULT '', last_change DATETIME DEFAULT (strftime('%Y-%m-%dT%H:%M:%fZ','now')), min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);
CREATE TABLE gpkg_geometry_columns (table_name TEXT NOT NULL, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL, PRIMARY KEY (table_name, column_name));
"""


def local(path: str) -> str:
    """A path without its scheme; only shared disks that are mounted can be read."""
    if "://" in path and not path.startswith("file://"):
        raise ValueError(f"{path} must be on a mounted disk")
    return "/" + path[5:].lstrip("/") if path.startswith("file:") else path


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _opened(path: str) -> contextlib.closing:
    return contextlib.closing(sqlite3.connect(f"file:{path.replace('%', '%25').replace('?', '%3f').replace('#', '%23')}?mode=ro&immutable=1", uri=True))


def _files(path: str) -> list[str]:
    if not os.path.isdir(path):
        return [path]
    return [os.path.join(path, f) for f in sorted(os.listdir(path)) if f.endswith(".gpkg") and not f.startswith(".")]


def _type(declared: str) -> DataType:
    name = declared.upper().split("(")[0]
    if name == "BOOLEAN":
        return BooleanType()
    if "INT" in name:
        return LongType()
    if name in ("DOUBLE", "FLOAT", "REAL"):
        return DoubleType()
    return BinaryType() if name == "BLOB" else StringType()


@dataclass
class Rows(InputPartition):
    """Rows of a file from one id to before another."""

    path: str
    low: int
    high: int


@dataclass
class Written(WriterCommitMessage):
    """The file that a task wrote, if any."""

    path: str | None


class GeoPackage(DataSource):
    """Options: path, table (needed if a file has several), rows a task. Writing: geometry (the column of polygons), srs.

    Reading gives the table's columns, the geometry as polygons: null for points, lines and nulls. Dates stay text.
    """

    @classmethod
    def name(cls) -> str:
        return "geopackage"

    def _path(self) -> str:
        return local(self.options["path"])

    def _table(self, db: sqlite3.Connection) -> tuple[str, str]:
        """The table to read and its geometry's column."""
        found = dict(db.execute("SELECT table_name, column_name FROM gpkg_geometry_columns"))
        named = self.options.get("table")
        if (named is None and len(found) != 1) or (named is not None and named not in found):
            raise ValueError(f"the option table must be one of {sorted(found)}")
        name = named or next(iter(found))
        return name, found[name]

    def schema(self) -> StructType:
        files = _files(self._path())
        if not files:
            raise ValueError(f"no GeoPackage in {self._path()}")
        with _opened(files[0]) as db:
            table, shape = self._table(db)
            return StructType([StructField(c[1], POLYGONS_TYPE if c[1] == shape else _type(c[2])) for c in db.execute(f"PRAGMA table_info({_quoted(table)})")])

    def reader(self, schema: StructType) -> DataSourceReader:
        return Reader(self, schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return Writer(self._path(), schema, overwrite, self.options.get("table", "features"), self.options.get("geometry", "geom"), int(self.options.get("srs", "0")))


class Reader(DataSourceReader):
    def __init__(self, source: GeoPackage, schema: StructType):
        self.source, self.fields, self.rows = source, schema.fields, int(source.options.get("rows", ROWS))

    def partitions(self) -> list[Rows]:
        """Equal ranges of ids, as many as the rows need; where ids have gaps some tasks get fewer rows."""
        found = []
        for path in _files(self.source._path()):
            with _opened(path) as db:
                table, _ = self.source._table(db)
                low, high, n = db.execute(f"SELECT min(rowid), max(rowid), count(*) FROM {_quoted(table)}").fetchone()
            pieces = -(-n // self.rows)
            found += [Rows(path, low + (high + 1 - low) * k // pieces, low + (high + 1 - low) * (k + 1) // pieces) for k in range(pieces)]
        return found

    def read(self, partition: Rows | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no file has a row
            return
        with _opened(partition.path) as db:
            table, shape = self.source._table(db)
            rows = db.execute(f"SELECT {', '.join(_quoted(f.name) for f in self.fields)} FROM {_quoted(table)} WHERE rowid >= ? AND rowid < ?", (partition.low, partition.high))
            while batch := rows.fetchmany(BATCH):
                yield pa.RecordBatch.from_arrays([self._column(f, v, f.name == shape) for f, v in zip(self.fields, zip(*batch, strict=True), strict=True)], [f.name for f in self.fields])

    @staticmethod
    def _column(field: StructField, values: tuple, shape: bool) -> pa.Array:
        if shape:
            return polygons_column([packaged_polygons(v) for v in values])
        if isinstance(field.dataType, BooleanType):
            return pa.array([None if v is None else bool(v) for v in values], pa.bool_())
        if isinstance(field.dataType, StringType):  # a column may hold values of other types than it declares
            return pa.array([v if v is None or isinstance(v, str) else str(v) for v in values], pa.string())
        return pa.array(values, {LongType: pa.int64(), DoubleType: pa.float64(), BinaryType: pa.binary()}[type(field.dataType)])


class Writer(DataSourceArrowWriter):
    """Each task writes a hidden file; the driver gives the files of the tasks that count their names."""

    def __init__(self, path: str, schema: StructType, overwrite: bool, table: str, shape: str, srs: int):
        self.path, self.fields, self.replace, self.table, self.shape, self.srs = path, schema.fields, overwrite, table, shape, srs
        odd = [f.name for f in self.fields if f.name != shape and type(f.dataType) not in SQL_TYPES]
        if odd or shape not in schema.names:
            raise ValueError(f"no type for columns {odd}" if odd else f"no column {shape}: name the polygons by the option geometry")

    def _file(self, batches: Iterator[pa.RecordBatch]) -> str:
        os.makedirs(self.path, exist_ok=True)
        path = os.path.join(self.path, f".part-{uuid.uuid4().hex}.gpkg")
        columns = ", ".join(f"{_quoted(f.name)} {'GEOMETRY' if f.name == self.shape else SQL_TYPES[type(f.dataType)]}" for f in self.fields)
        with contextlib.closing(sqlite3.connect(path)) as db, db:
            db.executescript(f"PRAGMA application_id = {APPLICATION}; PRAGMA user_version = {VERSION}; PRAGMA journal_mode = OFF; {TABLES} CREATE TABLE {_quoted(self.table)} ({columns});")
            known = {self.srs: "EPSG"} | {-1: "NONE", 0: "NONE"}
            db.executemany("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, ?, ?, 'undefined', NULL)", [(f"{o}:{k}", k, o, k) for k, o in known.items()])
            db.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, srs_id) VALUES (?, 'features', ?, ?)", (self.table, self.table, self.srs))
            db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, ?, 'GEOMETRY', ?, 0, 0)", (self.table, self.shape, self.srs))
            header = struct.pack("<2sBBi", b"GP", 0, 1, self.srs)
            for batch in batches:
                values = [encoded(c, header) if f.name == self.shape else c.to_pylist() for f, c in zip(self.fields, batch.columns, strict=True)]
                db.executemany(f"INSERT INTO {_quoted(self.table)} VALUES ({', '.join('?' * len(values))})", zip(*values, strict=True))
        return path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        for first in iterator:

            def every():
                yield first
                yield from iterator

            return Written(self._file(every()))
        return Written(None)

    def commit(self, messages: list[Written | None]) -> None:
        old = _files(self.path) if self.replace and os.path.isdir(self.path) else []
        made = [m.path for m in messages if m is not None and m.path is not None] or [self._file(iter(()))]
        for path in made:
            os.replace(path, os.path.join(self.path, os.path.basename(path)[1:]))
        for path in old:
            os.remove(path)

    def abort(self, messages: list[Written | None]) -> None:
        for m in messages:
            if m is not None and m.path is not None and os.path.exists(m.path):
                os.remove(m.path)


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(GeoPackage)
