"""Work that once took rounds of joins, or a row for each strip and pair, done at once where it fits into a task."""

import numpy as np
import pytest
from conftest import SMALL, rows_of
from pyspark.sql import functions as F
from test_outline import BOX, cells_of, filled, frame, pieces_of, random_boxes

from geoloom import catalog
from geoloom.functions import boxes, chains
from geoloom.operators import graph, grids, outline, post

QUERIES = catalog.queries()


def test_boxes_that_cover_a_square_become_one(spark):
    """Neighbouring strips that keep the same stay one box, also where a cell's boxes are united by shares."""
    slid = spark.range(3000).select(F.lit(1).alias("g"), (F.col("id") % 100).alias("x0"), (F.col("id") % 77).alias("y0"), (F.col("id") % 100 + 30).alias("x1"), (F.col("id") % 77 + 30).alias("y1"))
    assert [tuple(r) for r in outline.boxes_where(slid, BOX, ["g"]).where("p_x0 >= 29 AND p_x1 <= 99").collect()] == []  # no strip within
    rows = [(1, 0, 0, 100, 50), *((1, x, y, x + 7, y + 9) for x in range(0, 90, 3) for y in range(0, 40, 3))]
    assert [tuple(r) for r in outline.boxes_where(frame(spark, rows), BOX, ["g"]).collect()] == [(1, 0.0, 0.0, 100.0, 50.0)]


@pytest.mark.parametrize("crowd", [1, 3])
def test_groups_of_any_size_have_the_same_outlines(spark, monkeypatch, crowd):
    monkeypatch.setattr(outline, "GROUP", 1)
    monkeypatch.setattr(outline, "CROWD", crowd)
    monkeypatch.setattr(chains, "ROWS", 5)
    monkeypatch.setattr(boxes, "WORK", 20)
    rows = [*random_boxes(np.random.default_rng(crowd), 16, 30), (101, 0, 0, 3, 1), (101, 0, 0, 1, 3), (101, 2, 0, 3, 2), (101, 0, 2, 2, 3)]
    found = outline.union_polygons(frame(spark, rows), BOX, ["g"], cell=5.0).collect()
    for g in {r[0] for r in rows}:
        grid, own = cells_of([b for k, *b in rows if k == g]), [r for r in found if r.g == g]
        assert (filled([r.polygon for r in own]) == grid).all()
        assert (len(own), sum(len(r.polygon) - 1 for r in own)) == pieces_of(grid)
        assert sorted(r.part for r in own) == list(range(len(own)))


def test_halves_of_a_large_group_cover_the_same(monkeypatch):
    rng = np.random.default_rng(3)
    low = rng.integers(0, 40, (2, 60)).astype(float)
    sides = [*low, *(low + rng.integers(1, 12, (2, 60)))]
    g, second = np.sort(rng.integers(0, 4, 60)), rng.random(60) < 0.4

    def cells(found):
        out = np.zeros((4, 60, 60), int)
        for k, a, b, c, d in zip(found[0], *found[1], strict=True):
            out[k, int(a) : int(c), int(b) : int(d)] += 1
        return out

    whole = cells(boxes.united(g, second, sides, [False, True, False, False]))
    monkeypatch.setattr(boxes, "WORK", 5)
    halves = cells(boxes.united(g, second, sides, [False, True, False, False]))
    assert whole.max() == 1 and (whole == halves).all()


def test_long_rings_and_chains_take_few_rounds(spark, monkeypatch):
    """A comb of 4 000 edges, and a path of 5 000 nodes."""
    monkeypatch.setattr(outline, "GROUP", 1)
    made = []
    for module in (outline, graph):
        monkeypatch.setattr(module, "stored", lambda df, keep=module.stored: made.append(1) or keep(df))
    comb = spark.range(1000).select(F.lit(1).alias("g"), (2 * F.col("id")).alias("x0"), F.lit(0).alias("y0"), (2 * F.col("id") + 1).alias("x1"), (2 + F.col("id") % 7).alias("y1"))
    found = outline.union_polygons(comb.union(spark.sql("SELECT 1, 0, 0, 1999, 1")), BOX, ["g"]).collect()
    assert len(found) == 1 and len(found[0].polygon[0]) == 4001 and len(made) < 20
    path = spark.range(5000).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    assert {r.component for r in graph.connected_components(path, near=True).collect()} == {0}


@pytest.mark.parametrize("name", ["union_outlines", "merge_across_tiles", "cluster_outlines"])
def test_queries_without_large_groups_are_the_same_by_joins(spark, monkeypatch, name):
    rows = lambda: sorted(map(repr, QUERIES[name](spark, SMALL).collect()))
    whole = rows()
    monkeypatch.setattr(outline, "GROUP", 2)
    assert whole == rows()


def test_sub_tiles_are_tried_in_the_row_of_their_image(spark, monkeypatch):
    """One exchange of nodata and one of images; images with much nodata go by joins and give the same."""
    found = QUERIES["sub_tiles"](spark, SMALL)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 3 and "_cx" not in plan
    rng = np.random.default_rng(5)
    images = spark.createDataFrame([(k, 100.0 * k, 0.0, 100.0 * k + 90, 70.0, 900, 700, 0.1) for k in range(8)], "n int, a double, b double, c double, d double, w int, h int, pixel double")
    holes = [(int(k), float(100 * k + x), float(y), float(100 * k + x + w), float(y + h)) for k, x, y, w, h in zip(rng.integers(0, 7, 60), *(rng.integers(0, 80, (2, 60)) * 1.0), *(rng.integers(0, 30, (2, 60)) * 1.0), strict=True)]
    nodata = spark.createDataFrame([*holes, (7, None, 0.0, 1.0, 1.0)], "n int, n_x0 double, n_y0 double, n_x1 double, n_y1 double")
    rows = lambda: rows_of(("n", "id", "side", *grids.CELL_BOX), [tuple(r) for r in grids.sub_tiles(images, ("a", "b", "c", "d"), "n", "w", "h", "pixel", nodata, (256, 128)).collect()])
    tried = rows()
    monkeypatch.setattr(grids, "HOLES", 8)
    assert tried == rows()
    monkeypatch.setattr(grids, "HOLES", 0)
    assert tried == rows()


@pytest.mark.parametrize("rows", [500, 1_000_000])
def test_pairs_that_overlap_are_not_written(spark, monkeypatch, rows):
    """Two stacks of 300 boxes have 89 700 pairs, of which a task keeps a link for each box and chunk of pairs at most."""
    monkeypatch.setattr(chains, "ROWS", rows)
    written, keep = [], graph.stored
    monkeypatch.setattr(graph, "stored", lambda df: written.append(keep(df)) or written[-1])
    stacks = spark.range(600).select(F.col("id").alias("det_id"), *((F.col("id") % 2 * 500 + F.col("id") % 3 + k).alias(c) for c, k in zip(post.DET_BOX, (0, 0, 20, 20), strict=True)))
    found = post.groups(stacks, post.overlapping(stacks)).collect()
    assert {(r.det_id % 2, r.component) for r in found} == {(0, 0), (1, 1)} and len(found) == 600
    assert max(df.count() for df in written) < (45_000 if rows == 500 else 1300)
