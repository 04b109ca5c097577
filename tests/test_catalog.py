import pytest
from conftest import SMALL, same_rows

from geoloom import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", list(SQL))
def test_query_gives_the_rows_of_its_sql(spark, name):
    same_rows(QUERIES[name](spark, SMALL), SQL[name])


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_known_counts(spark):
    found = {r.tag: r.n for r in QUERIES["fractional_counts"](spark, SMALL).collect()}
    assert found == {"TP": 356, "MISMATCHED CLASSES": 62, "FP": 273, "FN": 1082}


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 3
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_spatial_join_is_an_equi_join(spark):
    plan = QUERIES["iou_pairs"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
