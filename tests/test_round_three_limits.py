"""Steps that must not grow beyond their limits: nothing sent whole to the driver, no work that grows with the square."""

from conftest import SMALL

from geoloom import catalog
from geoloom.operators import outline

QUERIES = catalog.queries()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cells_of_sub_tiles_are_not_broadcast(spark):
    assert "Broadcast" not in plan_of(QUERIES["sub_tiles"](spark, SMALL))
    assert "Broadcast" not in plan_of(QUERIES["coverage_test"](spark, SMALL))


def test_boxes_know_their_piece_without_its_outline(spark, monkeypatch):
    monkeypatch.setattr(outline, "rings", lambda *_: 1 / 0)
    rows = [(0.0, 0.0, 2.0, 2.0), (2.0, 2.0, 3.0, 3.0), (2.0, 1.0, 4.0, 1.5), (3.0, 2.5, 5.0, 9.0), (2.5, 3.0, 2.6, 4.0)]
    found = outline.pieced(spark.createDataFrame(rows, "p_x0 double, p_y0 double, p_x1 double, p_y1 double"))
    assert {tuple(r)[1:]: r.part for r in found.collect()} == dict(zip(rows, (0, 1, 0, 1, 1), strict=True))
