"""The forest against a plain one with the same draws, and across partitionings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import forest


def table(spark, rows=4_000, partitions=8):
    n = F.col("id")
    noise = lambda i: (F.xxhash64(F.lit(i), n) % 1000).cast("double")
    frame = spark.range(rows).select(
        n.alias("k"), noise(1).alias("a"), (noise(2) / 10).cast("decimal(18,2)").alias("b"), (n % 3).cast("int").alias("c"), noise(4).alias("d"),
        F.when(n % 11 == 0, None).otherwise(noise(5)).alias("e"),
    )
    other = (F.xxhash64(F.lit(6), "k") % 1000).cast("double")
    label = (F.col("a") + 3 * F.col("b").cast("double") + other / 2 > 0).cast("int")
    return frame.withColumn("y", label).repartition(partitions, F.hash("k"))


COLUMNS = ("a", "b", "c", "d", "e")


def fitted(frame, **how):
    return forest.fit(frame, COLUMNS, F.col("y"), F.col("k"), **({"trees": 12, "depth": 4} | how))


def plain_tree(bins, labels, weight, seed, tree, depth, min_leaf):
    """The same tree grown node by node, breadth first, as nested tuples."""
    made, level = {0: None}, {0: 0}
    first_free = 1
    queue = [0]
    members = {0: np.arange(len(bins))}
    while queue:
        after = []
        for node in queue:
            rows = members[node]
            w = weight[rows]
            ones, zeros = (w * labels[rows]).sum(), (w * (1 - labels[rows])).sum()
            if level[node] == depth or (node and min(ones, zeros) == 0):
                continue
            best = None
            for feature in forest._drawn(seed, tree, node, bins.shape[1], int(np.ceil(np.sqrt(bins.shape[1])))):
                for cut in range(forest.BINS - 1):
                    left = bins[rows, feature] <= cut
                    n_left, n_right = w[left].sum(), w[~left].sum()
                    if min(n_left, n_right) < min_leaf:
                        continue
                    def impurity(mask):
                        one = (w * labels[rows])[mask].sum()
                        return 2 * one * (w[mask].sum() - one) / w[mask].sum()
                    gain = impurity(np.ones(len(rows), bool)) - impurity(left) - impurity(~left)
                    if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-12)):
                        best = gain, int(feature), cut, rows[left], rows[~left]
            if best:
                made[node] = best[1], best[2], first_free
                for at, part in enumerate(best[3:]):
                    members[first_free + at], level[first_free + at], made[first_free + at] = part, level[node] + 1, None
                after += [first_free, first_free + 1]
                first_free += 2
        queue = after
    return made


def test_equals_a_plain_forest_with_the_same_draws(spark):
    frame = table(spark, 1_500)
    model = fitted(frame, trees=4, depth=3, min_leaf=20)
    rows = frame.select(F.xxhash64("k").alias("row"), "y", *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in COLUMNS)).toPandas()
    values = rows[list(COLUMNS)].to_numpy()
    for i, cuts in enumerate(model.cuts):
        ordered = np.sort(values[:, i])
        assert np.array_equal(cuts, np.unique([ordered[int(np.ceil(len(ordered) * s / forest.BINS)) - 1] for s in range(1, forest.BINS)]))
    bins, labels, ids = model.bins(values), rows["y"].to_numpy(), rows["row"].to_numpy()
    for t, tree in enumerate(model.trees):
        weight = forest.weights(ids, 42, t)
        made = plain_tree(bins, labels, weight, 42, t, 3, 20)
        assert {n: (tree.feature[n], tree.cut[n], tree.child[n]) if tree.feature[n] >= 0 else None for n in range(len(tree.feature))} == made
        leaf = tree.leaves(bins)
        for n in set(leaf):
            assert tree.counts[n] == tuple(int(weight[(leaf == n) & (labels == c)].sum()) for c in (0, 1))


def test_rows_alike_are_one_and_keep_their_weights(spark):
    n = F.col("id")
    frame = spark.range(6_000).select(n.alias("k"), (n % 2).cast("int").alias("y"), F.when(n < 3_000, n * 0).otherwise(n % 4).alias("a"), (n % 3).alias("b"))
    rows = frame.select(F.xxhash64("k").alias("row"), F.col("y").alias("label"), F.array(F.col("a").cast("double"), F.col("b").cast("double")).alias("values")).repartition(3)
    model = forest.Forest(("a", "b"), forest._cuts(rows, ("a", "b")), [forest.Tree() for _ in range(5)])
    combined = forest._combined(rows, model, 7).toArrow().combine_chunks()
    assert combined.num_rows < 200  # 18 kinds, in some tasks and batches
    found = {}
    weights = forest._weights_of(combined.column("weights").chunk(0), 5)
    assert {len(w) for w in combined.column("weights").to_pylist()} == {5, 20}
    for kind, weight in zip(combined.column("alike").to_pylist(), weights, strict=True):
        found[kind] = found.get(kind, 0) + weight
    table = rows.toPandas()
    bins, expected = model.bins(np.stack(table["values"].to_numpy())), {}
    drawn = np.stack([forest.weights(table["row"].to_numpy(), 7, t) for t in range(5)], axis=1)
    for kind, label, weight in zip(bins, table["label"], drawn, strict=True):
        key = bytes([*kind, label])
        expected[key] = expected.get(key, 0) + weight
    assert {k: list(v) for k, v in found.items()} == {k: list(v) for k, v in expected.items()}


def test_partitions_and_order_change_nothing(spark):
    models = [fitted(table(spark, partitions=p)) for p in (1, 8, 64)]
    assert models[0].trees == models[1].trees == models[2].trees
    assert np.array_equal(models[0].importances(), models[2].importances())


def test_scores_separate_and_importances_find_the_cause(spark):
    frame = table(spark)
    model = fitted(frame, trees=40, depth=6)
    scored = model.score(frame.withColumn("_extra", F.lit("x")))
    assert scored.columns == [*frame.columns, "_extra", "probability"] and scored.count() == 4_000
    right = scored.where((F.col("probability") > 0.5) == (F.col("y") == 1)).count()
    assert right > 0.85 * 4_000
    importance = dict(zip(COLUMNS, model.importances()))
    assert sum(importance.values()) == pytest.approx(1) and min(importance["a"], importance["b"]) > max(importance[c] for c in "cde")


def test_weights_are_poisson_and_differ_by_tree_and_seed():
    ids = np.arange(200_000)
    one, two, three = forest.weights(ids, 1, 0), forest.weights(ids, 1, 1), forest.weights(ids, 2, 0)
    for w in (one, two, three):
        assert w.mean() == pytest.approx(1, abs=0.01) and w.var() == pytest.approx(1, abs=0.02)
        assert (w == 0).mean() == pytest.approx(np.exp(-1), abs=0.005)
    assert abs(np.corrcoef(one, two)[0, 1]) < 0.01 and abs(np.corrcoef(one, three)[0, 1]) < 0.01


def test_one_class_few_rows_and_none(spark):
    frame = table(spark, 50)
    alike = fitted(frame.withColumn("y", F.lit(1)), trees=3)
    assert {r.probability for r in alike.score(frame).collect()} <= {1.0} and alike.importances().sum() == 0
    none = fitted(frame.limit(0), trees=3)
    assert none.score(frame.limit(0)).count() == 0 and none.importances().sum() == 0
    unlabelled = fitted(frame.withColumn("y", F.when(F.col("k") < 25, F.col("y"))), trees=2)
    assert sum(unlabelled.trees[0].counts[0]) <= 60
