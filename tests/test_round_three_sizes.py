"""Results of dense tables without all pairs of their boxes."""

import random

import pytest
from pyspark.sql import functions as F

from geoloom.operators import assess, post, spatial

DET = "det_id long, score double, det_class int, year_det int, dataset string, d_x0 long, d_y0 long, d_x1 long, d_y1 long"
LABEL = "label_id long, label_class int, year_label int, dataset string, l_x0 long, l_y0 long, l_x1 long, l_y1 long"


def dense(n: int, seed: int, span: int = 90):
    """n boxes of 4 to 20 a side in a square of span: (x0, y0, x1, y1)."""
    r = random.Random(seed)
    for _ in range(n):
        x, y = r.randrange(span), r.randrange(span)
        yield x, y, x + r.randrange(4, 21), y + r.randrange(4, 21)


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w < 0 or h < 0:
        return None
    size = lambda c: (c[2] - c[0]) * (c[3] - c[1])
    return w * h / (size(a) + size(b) - w * h)


@pytest.fixture
def tables():
    dets = [(k, k * 31 % 97 / 97, k % 5, 2000 + k % 3, "ab"[k % 2], *b) for k, b in enumerate(dense(150, 1))]
    labels = [(k, k % 5 + 1, 2000 + k % 4, "ab"[k % 2], *b) for k, b in enumerate(dense(200, 2))]
    return dets, labels


@pytest.mark.parametrize("how", [{}, {"strict_year": True}, {"by_dataset": True}, {"iou": 0.6}, {"iou": 0.0}])
def test_best_matches_are_those_of_all_pairs(spark, tables, how):
    dets, labels = tables
    least, best = how.get("iou", assess.IOU), {}
    for d in dets:
        for k in labels:
            v = iou(d[5:], k[4:])
            fits = (not how.get("strict_year") or d[3] == k[2]) and (not how.get("by_dataset") or d[4] == k[3])
            if v is not None and v >= least and fits:
                best[d[0]] = max(best.get(d[0], (-1, 0)), (v, -k[0]))
    found = assess.best_matches(spark.createDataFrame(dets, DET), spark.createDataFrame(labels, LABEL), **how).collect()
    assert len(found) == len(best)
    assert {r.det_id: (r.iou, -r.label_id) for r in found} == best


@pytest.mark.parametrize("year", [None, "strict", "compat"])
def test_sets_come_without_all_pairs(spark, tables, year, monkeypatch):
    dets, labels = tables
    taken = []
    monkeypatch.setattr(assess, "iou_pairs", lambda *_, **__: taken.append(1) or 1 / 0)
    tagged = assess.fractional_sets(spark.createDataFrame(dets, DET), spark.createDataFrame(labels, LABEL), year=year).collect()
    met = {(d[0], k[0]): iou(d[5:], k[4:]) for d in dets for k in labels if iou(d[5:], k[4:]) is not None}
    agreed = {p: v for p, v in met.items() if not year or dets[p[0]][3] == labels[p[1]][2]}
    best, won = {}, {}
    for (d, k), v in agreed.items():
        best[d] = max(best.get(d, (-1, 0)), (v, -k))
    for d, (v, k) in best.items():
        if v >= assess.IOU:
            at = (-k, dets[d][3] if year else None)
            won[at] = max(won.get(at, (-1, 0)), (v, -d))
    matched = {(-d, k) for (k, _), (_, d) in won.items()}
    assert {(r.det_id, r.label_id) for r in tagged if r.tag in (assess.TP, assess.MISMATCH)} == matched
    for side, tag, n in ((0, assess.FP, len(dets)), (1, assess.FN, len(labels))):
        rest = set(range(n)) - {m[side] for m in matched}
        if year == "compat":
            rest -= {p[side] for p in met} - {p[side] for p in agreed}
        assert {r[1 + side] for r in tagged if r.tag == tag} == rest
    assert not taken


PLACED = "det_id long, image string, det_class int, score double, d_x0 long, d_y0 long, d_x1 long, d_y1 long"


@pytest.mark.parametrize("apart", [None, "image"])
@pytest.mark.parametrize("corners", [True, False])
@pytest.mark.parametrize("span", [60, 260])
def test_components_of_meeting_boxes(spark, apart, corners, span):
    rows = [(k, "abc"[k * k % 3], k % 3, 0.5, *b) for k, b in enumerate(dense(150, span, span))]
    rows += [(200, "a", 0, 0.5, 1000, 1000, 1016, 1016), (201, "b", 0, 0.5, 1016, 1016, 1032, 1032), (202, "c", 0, 0.5, 1032, 1020, 1040, 1030)]
    wide, high = (F.least(post.DET_BOX[k + 2], post.OTHER_BOX[k + 2]) - F.greatest(post.DET_BOX[k], post.OTHER_BOX[k]) for k in (0, 1))
    least, tied = {r[0]: r[0] for r in rows}, set()
    links = []
    for a in rows:
        for b in rows:
            w, h = min(a[6], b[6]) - max(a[4], b[4]), min(a[7], b[7]) - max(a[5], b[5])
            if a[0] < b[0] and a[2] == b[2] and w >= 0 and h >= 0 and (corners or w > 0 or h > 0) and (not apart or a[1] != b[1]):
                links.append((a[0], b[0]))
                tied |= {a[0], b[0]}
    for _ in rows:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    found = post.touching(spark.createDataFrame(rows, PLACED), ["det_class"], apart, None if corners else (wide > 0) | (high > 0)).collect()
    assert {r.det_id: r.component for r in found} == least and len(found) == len(rows)
    assert {r.det_id for r in found if r.tied} == tied


def test_boxes_around_one_point_cost_a_row_each(spark):
    boxes = spark.range(3000).select(F.col("id").alias("det_id"), F.lit(1).alias("det_class"), *((F.col("id") % 5 + k).alias(c) for c, k in zip(post.DET_BOX, (0, 0, 20, 20), strict=True)))
    assert spatial.star_edges(boxes, post.DET_BOX, "det_id", ["det_class"]).count() == 2999
    named = boxes.withColumn("component", F.lit(0))
    assert spatial.mixed_pairs(named, post.DET_BOX, post.OTHER_BOX, "det_id", "component", ["det_class"]).count() == 0


@pytest.mark.parametrize("apart", [None, "image"])
def test_components_are_found_among_ends(spark, monkeypatch, apart):
    boxes = spark.range(3000).select(
        F.col("id").alias("det_id"), F.lit(1).alias("det_class"), (F.col("id") % 2).alias("image"),
        *((F.col("id") % 5 + F.col("id") % 3 * 30 + k).alias(c) for c, k in zip(post.DET_BOX, (0, 0, 40, 40), strict=True)),
    )
    sizes, find = [], post.connected_components
    monkeypatch.setattr(post, "connected_components", lambda e, *a: sizes.append(e.distinct().count()) or find(e, *a))
    found = post.touching(boxes, ["det_class"], apart).collect()
    assert len(found) == 3000 and {(r.component, r.tied) for r in found} == {(0, True)}
    assert max(sizes) < 300
