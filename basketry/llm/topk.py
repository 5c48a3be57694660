"""Exact nearest vectors by inner product: columnar branch and bound over blocks.

Vectors are integers. A block of queries meets candidates page by page, and both lie heaviest dimensions first. A few
dimensions are added up at a time for all pairs of a tile. What the dimensions not yet added can still give is at most the
product of the remaining norms; a pair whose sum plus that mass falls below the query's k-th best so far is given up, and
once few pairs are left these are compacted before the next dimensions. The k-th best carries on from page to page.

Queries are a stated part of the rows. Both tables are packed into pages where they lie, and the pages are dealt to a grid: a
task holds one block of queries and meets the candidates of one lane. Neither side is joined, so none can be taken for small
and sent through the driver, and blocks, lanes and pages are bounded by their numbers however large the tables are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import written

PAGE, HELD, LANE = 1 << 16, 1 << 22, 1 << 24  # numbers in a page, a block of queries, a lane; a row counts its parts and one more
BLOCKS, LANES = 3, 8  # that tables of some pages have at least, so that all cores have work
TILE, STEP = 256, 16  # queries of a tile, dimensions added at a time
PAGES = "dims int, rows int, width int, ids binary, flat binary"
FOUND = "query_id long, vec_id long, score long"
LOWEST, HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def integer_vectors(embeddings: DataFrame, scale: float = 64.0) -> DataFrame:
    """(vec_id, vector): floor(scale * x) of every component; vectors null or with null or non-finite components go.

    An empty vector stays and scores 0 with other empty ones.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("vector"),
    )


def remaining(vectors: np.ndarray) -> tuple[np.ndarray, float]:
    """Per row the norm that is left after every step, and the longest row's whole norm."""
    many, dims = vectors.shape
    if not vectors.size:
        return np.zeros((many, max(1, -(-dims // STEP)))), 0.0
    steps = np.add.reduceat(np.square(vectors.astype(np.float64)), np.arange(0, dims, STEP), axis=1)
    left = np.sqrt(np.cumsum(steps[:, ::-1], axis=1)[:, ::-1])
    return np.pad(left[:, 1:], ((0, 0), (0, 1))), float(left[:, 0].max())


class Block:
    """Queries, heaviest dimensions first, with the norms that remain after every step and the k best found so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.k = ids, k
        weight = np.zeros(vectors.shape[1])
        for at in range(0, len(ids), TILE):
            weight += np.square(vectors[at : at + TILE].astype(np.float64)).sum(axis=0)
        self.order = np.argsort(-weight, kind="stable")
        self.vectors, self.turned = vectors[:, self.order], {}
        self.left, self.length = remaining(self.vectors)
        self.cuts = [slice(c, c + STEP) for c in range(0, max(1, vectors.shape[1]), STEP)]
        self.best = [np.zeros(0, dtype=np.int64)] * 3  # places of queries, ids and scores
        self.score, self.last = np.full(len(ids), LOWEST), np.full(len(ids), HIGHEST)  # of the k-th best, once there are k
        self.least = np.full(len(ids), -np.inf)  # its score for bounds
        self.new, self.waiting = [], 0
        self.room = {}

    def _room(self, name: str, rows: int, many: int, kind: type) -> np.ndarray:
        """Rows of many numbers each, in memory that the next tile uses again."""
        if len(self.room.get((name, kind), ())) < rows * many:
            self.room[name, kind] = np.empty(rows * many, dtype=kind)
        return self.room[name, kind][: rows * many].reshape(rows, many)

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Candidates of one page; among those of one score the smaller ids come first."""
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order][:, self.order]
        rest, length = remaining(vectors)
        reach = self.length * length
        kind = np.float32 if reach < 2**23 else np.float64 if reach < 2**52 else np.int64  # in which sums are exact
        bounds = np.float32 if kind is np.float32 else np.float64
        if kind not in self.turned:
            self.turned[kind] = self.vectors.astype(kind), (self.left * (1 + 1e-9)).astype(bounds)
        slack = 16 * float(np.finfo(bounds).eps) * reach + 1e-6  # of bounds, for their rounding
        columns, rest = np.ascontiguousarray(vectors.T, dtype=kind), np.ascontiguousarray(rest.T, dtype=bounds)
        for at in range(0, len(self.ids), TILE):
            self._tile(slice(at, at + TILE), ids, columns, rest, *self.turned[kind], slack)
            if 2 * self.waiting > self.k * len(self.ids):
                self._merge()
        if self.waiting and self.score.min() == LOWEST:
            self._merge()

    def _tile(self, tile: slice, ids: np.ndarray, columns: np.ndarray, rest: np.ndarray, queries: np.ndarray, left: np.ndarray, slack: float) -> None:
        own, queries, left, least = self.ids[tile], queries[tile], left[tile], self.least[tile].astype(rest.dtype)
        size = len(own), len(ids)
        total, part, mass = (self._room(n, *size, t) for n, t in (("total", columns.dtype.type), ("part", columns.dtype.type), ("mass", rest.dtype.type)))
        alive, pairs = self._room("alive", *size, np.bool_), None

        def may(some: slice, step: int) -> np.ndarray:
            bound = np.multiply(left[some, step, None], rest[step], out=mass[some])
            return np.greater_equal(np.add(bound, total[some], out=bound), least[some, None] - slack, out=alive[some])

        for step, cut in enumerate(self.cuts):
            if pairs is None:
                np.matmul(queries[:, cut], columns[cut], out=part if step else total)
                if step:
                    total += part
                if step + 1 == len(self.cuts):
                    break
                few = slice(0, max(1, len(own) // 32))  # whether it pays to look at all is asked of some queries
                if np.mean(may(few, step)) > 1 / 32:
                    continue
                left_over = np.flatnonzero(may(slice(None), step))
                if 16 * len(left_over) <= total.size:
                    pairs, total = np.divmod(left_over, len(ids)), total.ravel()[left_over]
            else:
                query, vector = pairs
                total = total + np.einsum("pd,dp->p", queries[query, cut], columns[cut][:, vector])
                stays = total + left[query, step] * rest[step, vector] + slack >= least[query]
                pairs, total = (query[stays], vector[stays]), total[stays]
        if pairs is None:
            left_over = np.flatnonzero(self._first(total, least, own, ids))
            pairs, total = np.divmod(left_over, len(ids)), total.ravel()[left_over]
        query, vector = pairs
        query, found, total = query + tile.start, ids[vector], total.astype(np.int64)
        better = (total > self.score[query]) | ((total == self.score[query]) & (found < self.last[query]))
        kept = better & (found != self.ids[query])
        self.new.append((query[kept], found[kept], total[kept]))
        self.waiting += len(self.new[-1][0])

    def _first(self, total: np.ndarray, least: np.ndarray, own: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which pairs of a tile may be among the best: of many, the k best of each query and other id."""
        may = total >= least[:, None]
        if len(ids) > self.k and np.count_nonzero(may) > 4 * self.k * len(own):
            other = np.where(ids == own[:, None], LOWEST if total.dtype == np.int64 else -np.inf, total)
            bar = np.partition(other, len(ids) - self.k, axis=1)[:, len(ids) - self.k, None]
            ties = other == bar
            may &= (other > bar) | (ties & (np.cumsum(ties, axis=1) <= self.k))
        return may

    def _merge(self) -> None:
        query, ids, score = (np.concatenate(c) for c in zip(self.best, *self.new, strict=True))
        order = np.lexsort((ids, ~score, query))
        query, ids, score = query[order], ids[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        full = place == self.k - 1
        self.score[query[full]], self.last[query[full]], self.least[query[full]] = score[full], ids[full], score[full]
        self.best = [c[place < self.k] for c in (query, ids, score)]
        self.new, self.waiting = [], 0

    def found(self) -> Iterator[pa.RecordBatch]:
        """The k best of every query with another id, ties to smaller ids."""
        self._merge()
        query, ids, score = self.best
        for at in range(0, len(query), PAGE):
            some = slice(at, at + PAGE)
            yield pa.RecordBatch.from_pydict({"query_id": self.ids[query[some]], "vec_id": ids[some], "score": score[some]})


def _narrow(vectors: np.ndarray) -> np.ndarray:
    """The same in the narrowest integers that hold them."""
    low, high = int(vectors.min(initial=0)), int(vectors.max(initial=0))
    return vectors.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def _pages(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The rows in pages, each of one number of dimensions, written with a number each; and how many numbers they hold."""
    page = PAGE

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column("vec_id").to_numpy(), batch.column("vector")
            lengths, flat = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
            begins = np.cumsum(lengths, dtype=np.int64) - lengths
            packed = []
            for dims in np.unique(lengths).tolist():
                which, many = np.flatnonzero(lengths == dims), max(1, page // (dims + 1))
                for at in range(0, len(which), many):
                    some = which[at : at + many]
                    vectors = _narrow(flat[begins[some, None] + np.arange(dims)])
                    packed.append((dims, len(some), vectors.itemsize, ids[some].tobytes(), vectors.tobytes()))
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in packed], kind) for i, kind in enumerate(kinds)], ["dims", "rows", "width", "ids", "flat"])

    packed = rows.select("vec_id", "vector").mapInArrow(pack, PAGES).withColumn("number", F.monotonically_increasing_id())
    kept = written(packed, name)
    return kept, kept.agg(F.sum(F.col("rows") * (F.col("dims") + 1).cast("long"))).first()[0] or 0


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, np.ndarray, np.ndarray]]:
    """Of every page the number of dimensions, whether it holds queries, ids and vectors."""
    for batch in batches:
        for at in range(batch.num_rows):
            dims, rows, width, asked, ids, flat = (batch.column(n)[at] for n in ("dims", "rows", "width", "asked", "ids", "flat"))
            vectors = np.frombuffer(flat.as_buffer(), dtype=f"i{width.as_py()}").reshape(rows.as_py(), dims.as_py())
            yield dims.as_py(), asked.as_py(), np.frombuffer(ids.as_buffer(), dtype=np.int64), vectors


def nearest(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of every query with other ids, ties to smaller ids.

    Both tables are (vec_id, vector of integers). Every row is a candidate, repeated ones each, and a query meets vectors of its
    own number of dimensions. Query rows of one id are one query: the best of all their pairs with candidates, each pair
    for itself. A query without any other vector has no rows. Scores are 64-bit.
    """
    candidates, met = _pages(vectors, "vectors")
    asked, held = _pages(queries, "queries")
    blocks = max(math.ceil(held / HELD), min(BLOCKS, math.ceil(held / PAGE)), 1)
    lanes = max(math.ceil(met / LANE), min(LANES, math.ceil(met / (4 * PAGE))), 1)
    page = PAGE

    def part(many: int) -> Column:
        """Pages of one partition, and the first ones of all, go to one part after another; numbers hold both in 31 and 33 bits."""
        return F.pmod(F.shiftright("number", 33) + F.col("number").bitwiseAND((1 << 33) - 1), F.lit(many))

    def every(many: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(many - 1)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dims, pages in groupby(_opened(batches), key=lambda p: p[0]):
            block, own, other, rows = None, [], [], 0
            for _, is_asked, *both in pages:  # those with queries come first
                if is_asked:
                    own.append(both)
                elif own:
                    block = block or Block(*map(np.concatenate, zip(*own, strict=True)), k)
                    other, rows = [*other, both], rows + len(both[0])
                    if rows * (dims + 1) >= page // 2:
                        block.meet(*map(np.concatenate, zip(*other, strict=True)))
                        other, rows = [], 0
            if other:
                block.meet(*map(np.concatenate, zip(*other, strict=True)))
            if block:
                yield from block.found()

    dealt = asked.select("*", part(blocks).alias("block"), every(lanes).alias("lane"), F.lit(True).alias("asked"))
    dealt = dealt.unionByName(candidates.select("*", every(blocks).alias("block"), part(lanes).alias("lane"), F.lit(False).alias("asked")))
    cell = (F.col("block") * lanes + F.col("lane")).cast("int")
    dealt = dealt.withColumn("cell", cell).repartitionById(blocks * lanes, "cell").sortWithinPartitions("dims", F.desc("asked"), "number")
    found = dealt.mapInArrow(search, FOUND)
    along = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(along)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
