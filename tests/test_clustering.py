"""Many clusterings at once against plain K-Means, the library's evaluator and brute force."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from basketry.operators import clustering


def lloyd(points, centres):
    """Plain Lloyd's method until nothing moves."""
    while True:
        squared = np.square(points[:, None] - centres[None]).sum(axis=2)
        mine = squared.argmin(axis=1)
        moved = np.array([points[mine == c].mean(axis=0) if (mine == c).any() else centres[c] for c in range(len(centres))])
        if np.array_equal(moved, centres):
            return centres, squared.min(axis=1).sum()
        centres = moved


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(5, 3)) * 4
    made = np.concatenate([rng.normal(size=(700, 3)) + m for m in middles] + [np.tile(middles[0], (1500, 1))])  # a third is one point
    return made[rng.permutation(len(made))]


@pytest.fixture(scope="module")
def blocks(spark, points):
    frame = spark.createDataFrame([tuple(map(float, p)) for p in points], "x double, y double, z double").repartition(6)
    made = clustering.Blocks(frame, ["x", "y", "z"])
    yield made
    made.close()


def test_blocks_hold_every_point_once_and_are_tight(blocks, points):
    flat = np.concatenate([np.array(r.flat).reshape(-1, 3) for r in blocks.scan.collect()])
    assert blocks.rows == len(flat) == len(points)
    assert np.array_equal(flat[np.lexsort(flat.T)], points[np.lexsort(points.T)])
    tasks = [r["count"] for r in blocks.scan.groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) <= 2 * np.median(tasks)


def test_one_scan_equals_plain_sums_for_all_sets_of_centres(blocks, points):
    rng = np.random.default_rng(1)
    sets = [points[rng.choice(len(points), k, replace=False)] for k in (1, 2, 5, 9)] + [np.array([[0.0, 0, 0], [0, 0, 0], [1e9, 0, 0]])]
    found = clustering.step(blocks, sets)
    for at, centres in enumerate(sets):
        squared = np.square(points[:, None] - centres[None]).sum(axis=2)
        mine = squared.argmin(axis=1)
        assert {c for run, c in found if run == at} == set(mine)
        for c in set(mine):
            many, cost, sums = found[at, c]
            assert many == (mine == c).sum()
            assert cost == pytest.approx(squared[mine == c, c].sum()) and sums == pytest.approx(points[mine == c].sum(axis=0))


def test_most_distances_are_skipped(spark):
    n = F.col("id")
    frame = spark.range(60_000).select(*((F.randn(i) + (F.xxhash64(F.lit(i), n % 5) % 8)).alias(c) for i, c in enumerate("xyz")))
    blocks = clustering.Blocks(frame, ["x", "y", "z"])
    centres = clustering.best_runs(blocks, [5], restarts=2)[5].centres
    rows = [np.array(r.flat).reshape(-1, 3) for r in blocks.scan.collect()]
    blocks.close()
    left = [len(clustering.Block(0, p).candidates(centres)) for p in rows]
    assert np.mean(left) < 2 and left.count(1) > len(left) / 3


def test_every_run_ends_where_plain_kmeans_does(blocks, points):
    for run in clustering.fit_runs(blocks, [(k, seed) for k in (2, 3, 5, 8) for seed in (1, 2, 3)]):
        assert run.settled and len(run.centres) == run.k
        _, cost = lloyd(points, run.centres)
        assert run.cost == pytest.approx(cost, rel=1e-4)


def test_best_of_ten_is_as_good_as_the_librarys(spark, blocks, points):
    frame = spark.createDataFrame([tuple(map(float, p)) for p in points], "x double, y double, z double")
    data = VectorAssembler(inputCols=["x", "y", "z"], outputCol="features").transform(frame).persist()
    best = clustering.best_runs(blocks, range(2, 7))
    for k, run in best.items():
        theirs = min(KMeans(k=k, seed=s, tol=0.0, maxIter=300).fit(data).summary.trainingCost for s in range(3))
        assert run.cost <= theirs * (1 + 1e-4)
    rated = clustering.silhouettes(blocks, [run.centres for run in best.values()])
    for (k, run), value in zip(best.items(), rated, strict=True):
        number, squared = clustering.nearest_centre([F.col(c) for c in "xyz"], run.centres)
        with_number = data.withColumns({"prediction": number, "squared": squared})
        assert with_number.agg(F.sum("squared")).first()[0] == pytest.approx(run.cost)
        assert value == pytest.approx(ClusteringEvaluator().evaluate(with_number), abs=1e-9)


def test_scans_are_as_many_as_steps(blocks, monkeypatch):
    scans = []
    step = clustering.step
    monkeypatch.setattr(clustering, "step", lambda *a: scans.append(1) or step(*a))
    runs = clustering.fit_runs(blocks, [(k, seed) for k in range(2, 9) for seed in range(10)])
    assert len(scans) == max(r.steps for r in runs) + 2  # weights of the picks, variance


def test_few_equal_and_odd_points(spark):
    rows = [(1.0, 1.0)] * 5 + [(2.0, 2.0), (None, 1.0), (float("nan"), 1.0), (float("inf"), 0.0)]
    made = clustering.Blocks(spark.createDataFrame(rows, "x double, y double"), ["x", "y"])
    (run,) = clustering.fit_runs(made, [(4, 1)])
    assert made.rows == 6 and run.cost == 0 and {tuple(c) for c in run.centres} == {(1.0, 1.0), (2.0, 2.0)}
    assert clustering.silhouettes(made, [run.centres[:1], np.array([[1.0, 1.0], [2.0, 2.0]])])[0] is None
    nothing = clustering.Blocks(spark.createDataFrame([], "x double, y double"), ["x", "y"])
    assert clustering.fit_runs(nothing, [(2, 1)])[0].centres.size == 0 and clustering.silhouettes(nothing, [np.ones((2, 2))]) == [None]
