import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def duck(sf_dir: str = SMALL):
    import duckdb

    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(repr(r[k]) for k in order) for r in rows))


def same_rows(df, sql: str, sf_dir: str = SMALL):
    """The rows of df and of sql over the tables, both in one order."""
    found = duck(sf_dir).sql(sql)
    assert sorted(df.columns) == sorted(found.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(found.columns, found.fetchall())
