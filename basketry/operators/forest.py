"""A random forest for two classes whose result follows from the rows and the seed alone, however they are partitioned.

Every row draws its weight in every tree from a Poisson distribution by a hash of (seed, tree, row): bagging without an order of
rows. Features are cut into bins at exact quantiles, and rows alike in all bins and the label are one from then on: their weights
are drawn once and added up, tree by tree. All trees grow together, one level a scan of those: a task sums weights per (tree,
node, feature, bin, class), sums are whole numbers, and so neither their order nor the number of tasks can change a split.
What is shuffled is one row per task, tree, node and feature drawn for it; what reaches the driver is the best cut of each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.selection import values_at
from basketry.session import materialise
from basketry.store import discard

BINS = 32
# Chance of a Poisson variable of mean 1 to be at most 0, 1, 2, ...
AT_MOST = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(20)])


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that all output bits depend on all input bits."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def weights(rows: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row counts in a tree: Poisson with mean 1."""
    salt = mixed(np.array([(seed << 32) ^ (tree + 1)], dtype=np.uint64))
    even = (mixed(rows.view(np.uint64) ^ salt) >> np.uint64(11)) * 2.0**-53
    return np.searchsorted(AT_MOST, even, side="right")


@dataclass
class Tree:
    """Nodes in order of birth: cut feature (-1: leaf), cut bin, first of the two children, weight of both classes."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    child: list[int] = field(default_factory=lambda: [0])
    counts: list[tuple[int, int]] = field(default_factory=lambda: [(0, 0)])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row of bin numbers."""
        feature, cut, child = (np.array(a) for a in (self.feature, self.cut, self.child))
        at = np.zeros(len(bins), dtype=np.int64)
        while True:
            inner = np.flatnonzero(feature[at] >= 0)
            if not len(inner):
                return at
            node = at[inner]
            at[inner] = child[node] + (bins[inner, feature[node]] > cut[node])


@dataclass
class Forest:
    columns: tuple[str, ...]
    cuts: list[np.ndarray]  # per column: ascending values; bin b holds what exceeds cuts[b - 1] and not cuts[b]
    trees: list[Tree]

    def bins(self, values: np.ndarray) -> np.ndarray:
        """Bin numbers of rows of feature values; NaN lies above all."""
        return np.stack([np.searchsorted(c, values[:, i], side="left") for i, c in enumerate(self.cuts)], axis=1) if len(values) else np.zeros((0, len(self.cuts)), dtype=int)

    def importances(self) -> np.ndarray:
        """Share of every column in the fall of impurity, mean over trees."""
        total = np.zeros(len(self.columns))
        for tree in self.trees:
            own = np.zeros(len(self.columns))
            for feature, gain in zip(tree.feature, tree.gain, strict=True):
                if feature >= 0:
                    own[feature] += gain
            total += own / own.sum() if own.sum() > 0 else 0
        return total / total.sum() if total.sum() > 0 else total

    def probability(self, values: np.ndarray) -> np.ndarray:
        """Chance of class 1: mean over trees of its share in the row's leaf."""
        bins, total = self.bins(values), np.zeros(len(values))
        for tree in self.trees:
            counts = np.array(tree.counts, dtype=float)
            total += (counts[:, 1] / np.maximum(counts.sum(axis=1), 1))[tree.leaves(bins)]
        return total / max(len(self.trees), 1)

    def score(self, df: DataFrame, name: str = "probability") -> DataFrame:
        """Add the chance of class 1 to every row; nulls in a feature count as 0."""
        values = F.array(*(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.columns))

        def chances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                features = batch.column("_values").flatten().to_numpy().reshape(batch.num_rows, -1)
                rest = [c for c in batch.schema.names if c != "_values"]
                yield batch.select(rest).append_column(name, pa.array(self.probability(features), pa.float64()))

        kinds = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])
        return df.withColumn("_values", values).mapInArrow(chances, kinds)


def _cuts(rows: DataFrame, columns: Sequence[str]) -> list[np.ndarray]:
    """Per column the distinct values at exact shares of 1 / BINS, the greatest left out."""
    shares = [i / BINS for i in range(1, BINS)]
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("column"), F.col("values")[i].alias("value")) for i in range(len(columns)))))
    stacked = rows.select(each.alias("c")).select("c.*").where("value IS NOT NULL")
    found = values_at(stacked, "column", ["value"], shares, lambda n: [F.ceil(n * F.lit(s)).cast("bigint") for s in shares])
    cuts = [np.zeros(0)] * len(columns)
    for row in found.collect():  # one row per column
        cuts[row["column"]] = np.unique([row[f"_v{i}"]["value"] for i in range(len(shares))])
    return cuts


def _drawn(seed: int, tree: int, node: int, columns: int, wanted: int) -> np.ndarray:
    return np.sort(np.random.default_rng((seed, tree, node)).choice(columns, wanted, replace=False))


def _best_cut(sums: np.ndarray, min_leaf: int) -> tuple[int, float, list[int]] | None:
    """Cut bin, fall of impurity and class weights left and right of (bins, classes) sums; the first of equal ones."""
    left = sums.cumsum(axis=0)[:-1]
    right = sums.sum(axis=0) - left
    n_left, n_right = left.sum(axis=1), right.sum(axis=1)
    usable = (n_left >= max(min_leaf, 1)) & (n_right >= max(min_leaf, 1))
    if not usable.any():
        return None
    whole = sums.sum(axis=0)
    # Impurity times weight is 2 * ones * zeros / weight.
    before = 2 * whole[0] * whole[1] / whole.sum()
    after = 2 * left.prod(axis=1) / np.maximum(n_left, 1) + 2 * right.prod(axis=1) / np.maximum(n_right, 1)
    gain = np.where(usable, before - after, -np.inf)
    cut = int(gain.argmax())
    if gain[cut] <= 1e-9 * max(before, 1e-300) or before == 0:
        return None
    return cut, float(gain[cut]), [*map(int, left[cut]), *map(int, right[cut])]


def fit(
    df: DataFrame, columns: Sequence[str], label: Column, row: Column, trees: int = 200, depth: int = 6, min_leaf: int = 5, seed: int = 42
) -> Forest:
    """The forest. `label` is 0 or 1, `row` identifies a row; nulls in a feature count as 0, rows without a label go.

    Every node draws the square root of the number of columns, rounded up. Leaves hold at least `min_leaf` by weight.
    """
    values = F.array(*(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns))
    rows = df.where(label.isNotNull()).select(F.xxhash64(row).alias("row"), label.cast("int").alias("label"), values.alias("values"))
    rows, many = materialise(rows)
    forest = Forest(tuple(columns), _cuts(rows, columns), [Tree() for _ in range(trees)])
    if not many:
        return forest
    kept = _combined(rows, forest, seed).persist()
    try:
        live = [[0] for _ in range(trees)]  # nodes that may be cut, per tree
        for level in range(depth):
            live = _grown(kept, forest, live, level, min_leaf, seed)
            if not any(live):
                break
    finally:
        kept.unpersist()
        discard(rows)
    return forest


def _binary(rows: np.ndarray) -> pa.Array:
    """The bytes of each row of an array as one binary value."""
    data = np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * data.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of binary values, one after another, and where each ends."""
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8))[ends[0] : ends[-1]], ends - ends[0]


def _combined(rows: DataFrame, forest: Forest, seed: int) -> DataFrame:
    """(alike, weights): bins and label, a byte each, and the summed weight in every tree, one byte a tree where that is enough.

    Rows are dealt by ranges of (alike, row), so that many equal ones fill several tasks; what is alike may come several times.
    """
    columns, trees = len(forest.columns), len(forest.trees)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = forest.bins(batch.column("values").flatten().to_numpy().reshape(batch.num_rows, columns))
            alike = np.column_stack([bins, batch.column("label").to_numpy()]).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([_binary(alike), batch.column("row")], ["alike", "row"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            alike, own = _bytes(batch.column("alike"))[0].reshape(batch.num_rows, -1), batch.column("row").to_numpy()
            first = np.concatenate([[0], np.flatnonzero((alike[1:] != alike[:-1]).any(axis=1)) + 1])
            sums = np.stack([np.add.reduceat(weights(own, seed, t), first) for t in range(trees)], axis=1)
            narrow = sums.max(axis=1) < 256
            for part, kind in ((narrow, np.uint8), (~narrow, np.uint32)):
                if part.any():
                    yield pa.RecordBatch.from_arrays([_binary(alike[first[part]]), _binary(sums[part].astype(kind))], ["alike", "weights"])

    # As many tasks as the rows had: each of them sends sums of all trees, at every level.
    parts = rows._jdf.rdd().getNumPartitions()
    dealt = rows.mapInArrow(binned, "alike binary, row long").repartitionByRange(parts, "alike", "row").sortWithinPartitions("alike")
    return dealt.mapInArrow(add_up, "alike binary, weights binary")


def _weights_of(column: pa.Array, trees: int) -> np.ndarray:
    """Weights as `_combined` wrote them, a row per value."""
    data, ends = _bytes(column)
    lengths = np.diff(ends)
    narrow = lengths == trees
    found, in_narrow = np.empty((len(column), trees), dtype=np.int64), np.repeat(narrow, lengths)
    found[narrow] = data[in_narrow].reshape(-1, trees)
    found[~narrow] = data[~in_narrow].view(np.uint32).reshape(-1, trees)
    return found


def _grown(rows: DataFrame, forest: Forest, live: list[list[int]], level: int, min_leaf: int, seed: int) -> list[list[int]]:
    """Cut every live node where that helps, by one scan; the new nodes."""
    columns = len(forest.columns)
    wanted = math.ceil(math.sqrt(columns))
    drawn = {(t, n): _drawn(seed, t, n, columns, wanted) for t, nodes in enumerate(live) for n in nodes}

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(nodes), wanted, BINS, 2), dtype=np.int64) for nodes in live]
        for batch in batches:
            if not batch.num_rows:
                continue
            alike = _bytes(batch.column("alike"))[0].reshape(batch.num_rows, columns + 1).astype(np.int64)
            bins, label = alike[:, :columns], alike[:, columns]
            drawn_weights = _weights_of(batch.column("weights"), len(forest.trees))
            for t, nodes in enumerate(live):
                if not nodes:
                    continue
                tree = forest.trees[t]
                weight = drawn_weights[:, t]
                slot = np.full(len(tree.feature), -1)
                slot[nodes] = np.arange(len(nodes))
                at = slot[tree.leaves(bins)]
                here = np.flatnonzero((at >= 0) & (weight > 0))
                choice = np.stack([drawn[t, n] for n in nodes])
                for i in range(wanted):
                    place = ((at[here] * wanted + i) * BINS + bins[here, choice[at[here], i]]) * 2 + label[here]
                    sums[t].reshape(-1)[:] += np.bincount(place, weight[here], minlength=sums[t].size).astype(np.int64)
        for t, nodes in enumerate(live):
            if nodes:
                flat = sums[t].reshape(len(nodes) * wanted, BINS * 2)
                node, draw = np.repeat(nodes, wanted), np.tile(np.arange(wanted), len(nodes))
                arrays = pa.ListArray.from_arrays(np.arange(0, flat.size + 1, BINS * 2, dtype=np.int32), pa.array(flat.reshape(-1)))
                tree_of = pa.array(np.full(len(node), t), pa.int32())
                yield pa.RecordBatch.from_arrays([tree_of, pa.array(node, pa.int32()), pa.array(draw, pa.int32()), arrays], ["tree", "node", "draw", "sums"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for t, n, draw, flat in zip(*(batch.column(c).to_pylist() for c in ("tree", "node", "draw", "sums")), strict=True):
                best = _best_cut(np.array(flat, dtype=np.int64).reshape(BINS, 2), min_leaf)
                whole = np.array(flat).reshape(BINS, 2).sum(axis=0)
                at, gain, sides = best or (-1, 0.0, [])
                made.append((t, n, draw, at, gain, sides, [int(x) for x in whole]))
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], k) for i, k in enumerate(kinds)], ["tree", "node", "draw", "cut", "gain", "sides", "whole"])

    parts = rows.mapInArrow(add_up, "tree int, node int, draw int, sums array<long>")
    summed = parts.groupBy("tree", "node", "draw").agg(F.array(*(F.sum(F.col("sums")[i]) for i in range(2 * BINS))).alias("sums"))
    found = summed.mapInArrow(cut, "tree int, node int, draw int, cut int, gain double, sides array<long>, whole array<long>")
    best: dict[tuple[int, int], tuple] = {}
    for r in sorted(found.collect(), key=lambda r: (r["tree"], r["node"], r["draw"])):
        key = r["tree"], r["node"]
        if level == 0:
            forest.trees[r["tree"]].counts[0] = tuple(r["whole"])
        if r["cut"] >= 0 and (key not in best or r["gain"] > best[key][1]):
            best[key] = int(drawn[key][r["draw"]]), r["gain"], r["cut"], r["sides"]
    after: list[list[int]] = [[] for _ in live]
    for (t, n), (feature, gain, at, sides) in sorted(best.items()):
        tree = forest.trees[t]
        first = len(tree.feature)
        tree.feature[n], tree.cut[n], tree.child[n], tree.gain[n] = feature, at, first, gain
        for counts in (tuple(sides[:2]), tuple(sides[2:])):
            tree.feature.append(-1)
            tree.cut.append(0)
            tree.child.append(0)
            tree.gain.append(0.0)
            tree.counts.append(counts)
        after[t] = [*after[t], *(c for c in (first, first + 1) if min(tree.counts[c]) > 0)]
    return after
