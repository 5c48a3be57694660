"""Many K-Means runs over the same points in one scan per step, with distances skipped by the triangle inequality.

Points are packed once into blocks of neighbours along a space-filling curve; a block knows its middle and radius. Every step
of Lloyd's method reads the blocks once for all runs, whatever their number of clusters and seed. By the triangle inequality
a centre farther from a block's middle than the nearest centre by more than twice the radius is nearest to none of its points:
mostly one centre is left, and the block's own sums stand for its points. What is shuffled is one row per run, cluster and task;
what the driver holds are the centres.

Starts are drawn in the way of k-means||: two rounds of weighted picks from all points for all runs at once, then a weighted
k-means++ over the picks. Results follow from the points, the seeds and the blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import materialise
from basketry.store import discard

BLOCK = 256  # points
PICKS = 2  # per round, times the number of clusters
ROUNDS = 2


@dataclass
class Run:
    """One clustering: its number of clusters, its seed, and how far it has come."""

    k: int
    seed: int
    centres: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    cost: float = np.inf
    steps: int = 0
    settled: bool = False


class Blocks:
    """Points packed into blocks, `flat` (BLOCK x dimensions numbers) and `block`, written once and kept in memory."""

    def __init__(self, points: DataFrame, columns: Sequence[str]):
        self.dims = len(columns)
        values = [F.col(c).cast("double") for c in columns]
        sound = F.lit(True)
        for value in values:
            sound &= F.coalesce(F.abs(value) < float("inf"), F.lit(False))
        rows = points.select(F.array(*values).alias("point")).where(sound)
        least, most = (F.array(*(f(F.col("point")[i]) for i in range(self.dims))) for f in (F.min, F.max))
        self.rows, self.least, self.most = rows.agg(F.count(F.lit(1)), least, most).first()
        self.scan = self._packed(rows) if self.rows else rows

    def _packed(self, rows: DataFrame) -> DataFrame:
        least, width = np.array(self.least), np.maximum(np.array(self.most) - np.array(self.least), 1e-300)
        bits = min(16, 62 // self.dims)

        def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                points = batch.column("point").flatten().to_numpy().reshape(batch.num_rows, -1)
                cells = ((points - least) / width * (2**bits - 1)).astype(np.int64)
                key = np.zeros(batch.num_rows, dtype=np.int64)
                for bit in range(bits):
                    for i in range(cells.shape[1]):
                        key |= ((cells[:, i] >> bit) & 1) << (bit * cells.shape[1] + i)
                yield pa.RecordBatch.from_arrays([batch.column("point"), pa.array(key)], ["point", "key"])

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, many = [], 0
            for batch in batches:
                held.append(batch.column("point").flatten().to_numpy().reshape(batch.num_rows, -1))
                many += batch.num_rows
                if many >= 64 * BLOCK:
                    points = np.concatenate(held)
                    full = many // BLOCK * BLOCK
                    yield blocks(points[:full])
                    held, many = [points[full:]], many - full
            if many:
                yield blocks(np.concatenate(held))

        def blocks(points: np.ndarray) -> pa.RecordBatch:
            rows = [points[at : at + BLOCK].ravel() for at in range(0, len(points), BLOCK)]
            return pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64()))], ["flat"])

        # Equal points lie in many cells' place: a number of no meaning spreads them over partitions.
        curve = rows.mapInArrow(keyed, "point array<double>, key long").withColumn("salt", F.monotonically_increasing_id())
        curve = materialise(curve)[0]
        laid = curve.repartitionByRange("key", "salt").sortWithinPartitions("key", "salt").select("point")
        kept = materialise(laid.mapInArrow(packed, "flat array<double>").withColumn("block", F.monotonically_increasing_id()))[0]
        discard(curve)
        return kept.persist()

    def close(self) -> None:
        """Forget the blocks; nothing can be read from them any more."""
        if self.rows:
            self.scan.unpersist()
            discard(self.scan)

    def each(self, work: Callable[[Iterator[Block]], Iterator[list[tuple]]], kinds: str) -> DataFrame:
        """Rows that `work` gives for the blocks of a task."""
        dims, types = self.dims, [KINDS[c.split(" ")[1]] for c in kinds.split(", ")]
        names = [c.split(" ")[0] for c in kinds.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def read() -> Iterator[Block]:
                for batch in batches:
                    flat = batch.column("flat")
                    for at, number in enumerate(batch.column("block").to_pylist()):
                        yield Block(number, flat[at].values.to_numpy().reshape(-1, dims))

            for rows in work(read()):
                columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(types)]
                yield pa.RecordBatch.from_arrays(columns, names)

        return self.scan.mapInArrow(run, kinds)


KINDS = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}


class Block:
    """Some neighbouring points with their sums, middle and radius."""

    def __init__(self, number: int, points: np.ndarray):
        self.number, self.points = number, points
        self.sum = points.sum(axis=0)
        self.middle = self.sum / len(points)
        self.squares = np.square(points).sum(axis=1)
        self.radius = float(np.sqrt(np.square(points - self.middle).sum(axis=1).max()))

    def candidates(self, centres: np.ndarray) -> np.ndarray:
        """The centres that can be nearest to one of the points, in order."""
        away = np.sqrt(np.square(centres - self.middle).sum(axis=1))
        return np.flatnonzero(away <= away.min() + 2 * self.radius * (1 + 1e-12) + 1e-300)

    def distances(self, centres: np.ndarray) -> np.ndarray:
        """Squared distances of every point to every centre."""
        return np.square(self.points[:, None, :] - centres[None]).sum(axis=2)

    def nearest(self, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per point the nearest centre, the first of equally near ones, and the squared distance."""
        which = self.candidates(centres)
        squared = self.distances(centres[which])
        first = squared.argmin(axis=1)
        return which[first], squared[np.arange(len(first)), first]


def _collected(rows: DataFrame, dims: int) -> dict[tuple[int, int], tuple[int, float, np.ndarray]]:
    """Count, cost and coordinate sums per run and cluster: one row each."""
    sums = [F.sum(F.col("sums")[i]) for i in range(dims)]
    found = rows.groupBy("run", "cluster").agg(F.sum("many"), F.sum("cost"), F.array(*sums)).collect()
    return {(run, cluster): (many, cost, np.array(total)) for run, cluster, many, cost, total in found}


def step(blocks: Blocks, centres: Sequence[np.ndarray]) -> dict[tuple[int, int], tuple[int, float, np.ndarray]]:
    """One scan for all sets of centres: points, squared distances and coordinate sums of each (set, centre) that has any."""
    centres = [np.asarray(c, dtype=float) for c in centres]

    def add_up(given: Iterator[Block]) -> Iterator[list[tuple]]:
        many = [np.zeros(len(c)) for c in centres]
        cost = [np.zeros(len(c)) for c in centres]
        sums = [np.zeros(c.shape) for c in centres]
        for block in given:
            for run, own in enumerate(centres):
                which = block.candidates(own)
                if len(which) == 1:
                    at = which[0]
                    # Around the middle: the spread inside of the block and the way from there to the centre.
                    inner = np.square(block.points - block.middle).sum()
                    many[run][at] += len(block.points)
                    cost[run][at] += inner + len(block.points) * np.square(block.middle - own[at]).sum()
                    sums[run][at] += block.sum
                    continue
                squared = block.distances(own[which])
                first = squared.argmin(axis=1)
                many[run][which] += np.bincount(first, minlength=len(which))
                cost[run][which] += np.bincount(first, squared[np.arange(len(first)), first], minlength=len(which))
                for i in range(own.shape[1]):
                    sums[run][which, i] += np.bincount(first, block.points[:, i], minlength=len(which))
        yield [(run, c, int(many[run][c]), cost[run][c], sums[run][c]) for run, own in enumerate(centres) for c in range(len(own)) if many[run][c]]

    return _collected(blocks.each(add_up, "run int, cluster int, many long, cost double, sums array<double>"), blocks.dims)


def _picked(blocks: Blocks, runs: Sequence[Run], chosen: Sequence[np.ndarray], turn: int) -> list[np.ndarray]:
    """For every run a few points, drawn without replacement by their squared distance from what is chosen; one scan."""

    def draw(given: Iterator[Block]) -> Iterator[list[tuple]]:
        best: list[list[tuple]] = [[] for _ in runs]
        for block in given:
            for at, run in enumerate(runs):
                weight = np.ones(len(block.points)) if not len(chosen[at]) else block.nearest(chosen[at])[1]
                luck = np.random.default_rng((run.seed, run.k, turn, block.number)).exponential(size=len(weight))
                with np.errstate(divide="ignore"):
                    key = np.where(weight > 0, luck / weight, np.inf)
                wanted = PICKS * run.k if len(chosen[at]) else 1
                first = np.argsort(key, kind="stable")[:wanted]
                best[at] += [(at, float(key[i]), block.number, int(i), block.points[i]) for i in first if np.isfinite(key[i])]
                best[at] = sorted(best[at], key=lambda row: row[:4])[:wanted]
        yield [row for rows in best for row in rows]

    drawn = blocks.each(draw, "run int, key double, block long, place int, point array<double>")
    along = Window.partitionBy("run").orderBy("key", "block", "place")
    limit = F.lit(1) if not len(chosen[0]) else F.array(*(F.lit(PICKS * r.k) for r in runs))[F.col("run")]
    rows = drawn.withColumn("rank", F.row_number().over(along)).where(F.col("rank") <= limit).orderBy("run", "rank").collect()
    return [np.array([r["point"] for r in rows if r["run"] == at]).reshape(-1, blocks.dims) for at in range(len(runs))]


def _started(blocks: Blocks, runs: Sequence[Run]) -> None:
    """Centres to start from: picks of all rounds, weighted by the points nearest to them, thinned by k-means++."""
    chosen = _picked(blocks, runs, [np.zeros((0, blocks.dims))] * len(runs), 0)
    for turn in range(1, ROUNDS + 1):
        chosen = [np.concatenate([c, more]) for c, more in zip(chosen, _picked(blocks, runs, chosen, turn), strict=True)]
    weights = step(blocks, chosen)
    for at, run in enumerate(runs):
        picks = chosen[at]
        weight = np.array([weights.get((at, i), (0,))[0] for i in range(len(picks))], dtype=float)
        luck = np.random.default_rng((run.seed, run.k))
        centres = [picks[luck.choice(len(picks), p=weight / weight.sum())]]
        while len(centres) < run.k:
            left = weight * np.square(picks[:, None] - np.array(centres)[None]).sum(axis=2).min(axis=1)
            centres.append(picks[luck.choice(len(picks), p=left / left.sum())] if left.sum() > 0 else centres[0])
        run.centres = np.array(centres)


def fit_runs(blocks: Blocks, tries: Sequence[tuple[int, int]], tolerance: float = 1e-8, most: int = 300) -> list[Run]:
    """A run per (clusters, seed), all together: as many scans as the longest run has steps, and five to start.

    A run is settled when its centres move by at most `tolerance` of the points' variance, squared and summed; it then takes
    no part in later scans. A centre without points stays where it is, and fewer distinct points than clusters leave
    equal centres. Without any points the runs have no centres.
    """
    runs = [Run(k, seed) for k, seed in tries]
    if not blocks.rows or not runs:
        return runs
    _started(blocks, runs)
    (whole,) = step(blocks, [np.zeros((1, blocks.dims))]).values()
    variance = max(whole[1] / whole[0] - np.square(whole[2] / whole[0]).sum(), 0.0) / blocks.dims
    while live := [r for r in runs if not r.settled]:
        found = step(blocks, [r.centres for r in live])
        for at, run in enumerate(live):
            run.cost = sum(found[at, c][1] for c in range(run.k) if (at, c) in found)
            moved = np.array([found[at, c][2] / found[at, c][0] if (at, c) in found else run.centres[c] for c in range(run.k)])
            shift = np.square(moved - run.centres).sum()
            run.steps += 1
            run.settled = bool(shift <= tolerance * variance or run.steps >= most)
            if not run.settled:
                run.centres = moved  # a settled run keeps the centres that its cost was measured with
    return runs


def best_runs(blocks: Blocks, ks: Sequence[int], restarts: int = 10, seed: int = 42, **how) -> dict[int, Run]:
    """For every number of clusters the run of the lowest cost, of equal ones the first seed."""
    runs = fit_runs(blocks, [(k, seed + i) for k in ks for i in range(restarts)], **how)
    return {k: min((r for r in runs if r.k == k), key=lambda r: (r.cost, r.seed)) for k in ks}


def silhouettes(blocks: Blocks, centres: Sequence[np.ndarray]) -> list[float | None]:
    """Mean silhouette by squared Euclidean distances of each set of centres, all in two scans.

    The mean squared distance to a cluster follows from its count, sum and sum of squares. Lone points count 0; with fewer
    than two clusters there is none.
    """
    moments = [m for _, m in sorted(_moments(blocks, centres).items())]

    def rate(given: Iterator[Block]) -> Iterator[list[tuple]]:
        total, many = np.zeros(len(centres)), 0
        for block in given:
            many += len(block.points)
            for at, (own, (count, sums, squares)) in enumerate(zip(centres, moments, strict=True)):
                mine = block.nearest(own)[0]
                with np.errstate(invalid="ignore", divide="ignore"):
                    away = block.squares[:, None] - 2 * block.points @ (sums / count[:, None]).T + (squares / count)[None]
                away = np.where(count > 0, np.maximum(away, 0), np.inf)
                rows = np.arange(len(mine))
                size = count[mine]
                inside = away[rows, mine] * size / np.maximum(size - 1, 1)
                away[rows, mine] = np.inf
                outside = away.min(axis=1)
                greater = np.maximum(inside, outside)
                total[at] += np.where((size > 1) & (greater > 0), (outside - inside) / np.where(greater > 0, greater, 1), 0).sum()
        yield [(at, 0, many, total[at], []) for at in range(len(centres))]

    if not blocks.rows:
        return [None] * len(centres)
    rated = blocks.each(rate, "run int, cluster int, many long, cost double, sums array<double>").groupBy("run").agg(F.sum("cost") / F.sum("many"))
    found = dict(map(tuple, rated.collect()))
    return [found[at] if sum(m[0] > 0) > 1 else None for at, m in enumerate(moments)]


def _moments(blocks: Blocks, centres: Sequence[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per set of centres: counts, coordinate sums and sums of squared lengths of its clusters."""
    found = step(blocks, centres) if blocks.rows else {}
    made = {}
    for at, own in enumerate(np.asarray(c, dtype=float) for c in centres):
        empty = (0, 0.0, np.zeros(blocks.dims))
        count, cost, sums = (np.array([found.get((at, c), empty)[i] for c in range(len(own))]) for i in range(3))
        # From squared distances to the centre: |x|^2 = |x - c|^2 + 2 x c - |c|^2.
        made[at] = count, sums, cost + 2 * (sums * own).sum(axis=1) - count * np.square(own).sum(axis=1)
    return made


def nearest_centre(columns: Sequence[Column], centres: np.ndarray) -> tuple[Column, Column]:
    """Number of the nearest centre (the first of equally near ones) and its squared distance, as plain expressions."""
    squared = []
    for centre in np.asarray(centres, dtype=float):
        parts = [(c - F.lit(float(x))) * (c - F.lit(float(x))) for c, x in zip(columns, centre, strict=True)]
        squared.append(sum(parts[1:], parts[0]))
    least = F.least(*squared) if len(squared) > 1 else squared[0]
    return (F.array_position(F.array(*squared), least) - 1).cast("int"), least
