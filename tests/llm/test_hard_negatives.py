"""Hard negatives against a plain computation, over several blocks; the intervals against exact products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, every, positives=5, negatives=3):
    """Result rows as sorted tuples, from rows (vec_id, label, vector of ints)."""
    found = []
    for anchor, label, query in {(i, lab, v) for i, lab, v in rows if i % every == 0}:
        scored = [(-sum(a * b for a, b in zip(query, v)), i, lab) for i, lab, v in rows if len(v) == len(query)]
        best = sorted((s, i) for s, i, lab in scored if lab == label and i != anchor)[:positives]
        for positive, positive_id in best:
            near = sorted((s, i) for s, i, lab in scored if lab != label and -50 * positive <= -100 * s <= -95 * positive)
            found += [(anchor, positive_id, rank, i, -positive, -s) for rank, (s, i) in enumerate(near[:negatives], 1)]
    return sorted(found)


def integers(rows, scale=256.0):
    ok = [r for r in rows if None not in r and None not in r[1] and all(map(math.isfinite, r[1]))]
    return [(i, lab, tuple(math.floor(scale * float(np.float32(x))) for x in v)) for i, v, lab in ok]


def run(spark, rows, every):
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA + ", part string, block int, dims int").repartition(4)
    made = hn.integer_rows(frame, F.col("label"))
    return sorted(map(tuple, hn.hard_negatives(made, made.where(F.col("vec_id") % every == 0)).collect()))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(hn, "CANDIDATES", 300)
    monkeypatch.setattr(hn, "ANCHORS", 60)
    monkeypatch.setattr(hn, "ANCHOR_BLOCKS", 2)


def test_equals_plain_over_many_blocks(spark, small_blocks):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6) + 1], int(rng.integers(0, 3))) for i in range(200)]
    rows += [(300 + i, [1.0, 0.5, 0.25, 0.0, 1.0, 1.0], i % 2) for i in range(80)]  # one vector many times: ties to smaller ids
    rows += rows[:30]  # repeated whole
    assert run(spark, rows, 7) == plain(integers(rows), 7)


def test_odd_rows(spark, small_blocks):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [0.5 + i / 100, 0.25], i % 2) for i in range(20)]
    rows += [(20 + i, [0.5, 0.25 + i / 50, 0.1], i % 2) for i in range(20)]  # other number of dimensions
    rows += [(40, None, 1), (45, [0.1, None], 1), (50, [nan, 0.1], 1), (55, [inf, 0.1], 0), (60, [0.3, 0.1], None), (None, [0.3, 0.1], 1)]
    rows += [(65, [], 0), (66, [], 0), (67, [], 1), (70, [0.0, 0.0], 0), (75, [-0.5, -0.25], 0), (80, [9e4, 7e4], 1), (81, [8e4, 7e4], 1)]
    rows += [(0, [0.9, 0.1], 1), (5, [0.5, 0.3], 0)]  # ids that recur with another vector or label
    assert run(spark, rows, 5) == plain(integers(rows), 5)


def test_empty_and_alone(spark):
    assert run(spark, [], 5) == []
    assert run(spark, [(5, [1.0, 2.0], 1)], 5) == []
    assert run(spark, [(5, [1.0, 2.0], 1), (6, [1.0, 2.0], 1)], 5) == []  # a positive, but no negative


def test_sums_beyond_doubles_are_exact(spark):
    rows = [(i, [2.0**26 + i * 8, 2.0**25 + 8], i % 2) for i in range(12)]
    assert run(spark, rows, 5) == plain(integers(rows), 5)


@pytest.mark.parametrize("dims", [1, 3, 64, 100])
def test_intervals_hold_and_narrow(dims):
    rng = np.random.default_rng(dims)
    vectors = np.floor(256 * rng.normal(size=(500, dims))).astype(np.int64)
    vectors[:3] = 0
    codes, turned, all_of = hn.Codes(vectors), hn.rotated(vectors), np.arange(500)
    assert np.allclose(np.square(turned).sum(axis=1), np.square(vectors).sum(axis=1))
    for at in (0, 5, 77):
        query, middle, exact, widths = hn.Query(turned[at]), np.zeros(500), vectors @ vectors[at], []
        for stage in range(hn.STAGES):
            middle, reach = query.stage(codes, stage, all_of, middle)
            assert (np.abs(middle - exact) <= reach).all()
            widths.append(reach.mean())
        assert widths[-1] <= widths[0] and (dims < 64 or at == 0 or widths[-1] < 0.5 * widths[0])
