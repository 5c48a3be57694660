"""Nearest vectors over many blocks, lanes and pages against a plain computation; neither side goes through the driver."""

import numpy as np
import pytest

from basketry.llm import topk

SCHEMA = "vec_id long, vector array<long>"


@pytest.fixture
def small_grid(monkeypatch):
    for name, numbers in (("PAGE", 41 * 64), ("HELD", 41 * 150), ("LANE", 41 * 700)):
        monkeypatch.setattr(topk, name, numbers)


def plain(rows, every, k):
    found = []
    for q in {i for i, _ in rows if i % every == 0}:
        scored = [(-int(np.dot(own, v)), i) for j, own in rows if j == q for i, v in rows if i != q and len(v) == len(own)]
        found += [(q, rank, i, -score) for rank, (score, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found)


def run(spark, rows, every, k):
    table = spark.createDataFrame([(i, [int(x) for x in v]) for i, v in rows], SCHEMA).repartition(4)
    return sorted(map(tuple, topk.nearest(table, table.where(f"vec_id % {every} = 0"), k).collect()))


@pytest.mark.parametrize("length", [2**5, 2**18, 2**27])  # sums in floats, doubles and 64-bit integers
def test_equals_plain_over_many_cells(spark, small_grid, length):
    draw = np.random.default_rng(length)
    centres = draw.normal(size=(60, 40))
    rows = [(i, np.floor(length * (centres[i % 60] + draw.normal(size=40) / 9)).astype(np.int64)) for i in range(1500)]
    rows += [(2000 + i, rows[7][1]) for i in range(60)]  # one vector many times: ties to smaller ids
    rows += [(3000 + i, draw.integers(-length, length, 3)) for i in range(30)] + [(3100 + i, np.zeros(0, dtype=np.int64)) for i in range(9)]
    rows += rows[:20] + [(5, rows[6][1])]  # repeated whole, and an id with another vector
    assert run(spark, rows, 5, 9) == plain(rows, 5, 9)


def test_scores_of_one_sign_and_few_candidates(spark, small_grid):
    rows = [(i, np.full(40, -1 - i % 3) * (1 if i % 2 else -1)) for i in range(300)]
    assert run(spark, rows, 4, 20) == plain(rows, 4, 20)
    assert run(spark, rows[:6], 4, 20) == plain(rows[:6], 4, 20)
    assert run(spark, rows[:1], 4, 20) == []


def test_pairs_are_given_up_before_the_last_dimensions(monkeypatch):
    draw = np.random.default_rng(0)
    centres, ids = draw.normal(size=(200, 64)), np.arange(4000)
    vectors = np.floor(64 * (centres[ids % 200] + draw.normal(size=(4000, 64)) / 20)).astype(np.int64)
    block, gathered, einsum = topk.Block(ids[:300], vectors[:300], 5), [], np.einsum
    monkeypatch.setattr(np, "einsum", lambda how, a, b: gathered.append(len(a)) or einsum(how, a, b))
    for at in range(0, 4000, 500):
        block.meet(ids[at : at + 500], vectors[at : at + 500])
    found = sorted(tuple(r.values()) for batch in block.found() for r in batch.to_pylist())
    exact = vectors[:300] @ vectors.T
    exact[np.arange(300), np.arange(300)] = np.iinfo(np.int64).min
    want = sorted((q, int(i), int(exact[q, i])) for q in range(300) for i in np.lexsort((ids, ~exact[q]))[:5])
    assert found == want
    assert gathered and max(gathered) <= 300 * 500 / 16


def test_neither_side_goes_through_the_driver(spark):
    """The side of the queries, each there once for every block of candidates, was taken for small and broadcast."""
    rows = [(i, [(i * 7 + d) % 50 for d in range(8)]) for i in range(400)]
    table = spark.createDataFrame(rows, SCHEMA)
    found = topk.nearest(table, table.where("vec_id % 20 = 0"), 20)
    found.collect()
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
