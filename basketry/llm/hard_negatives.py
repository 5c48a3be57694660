"""Hard negatives by one-bit codes: popcount estimates, deterministic intervals, integer scores for what they cannot rule out.

Every vector x is turned by one fixed rotation and kept as the signs of its parts: a unit code vector c with parts of
equal size. Stored with it are the alignment a = <x, c> and the residual |x - a c|. A query q is turned too and rounded to
a few bits a part, q = p + e; <p, c> is a sum of popcounts of its bit planes met with the code. Then

    <q, x> = a <p, c> + <p - <p, c> c, x - a c> + <e, x>

and by Cauchy and Schwarz the last two are at most |p - <p, c> c| |x - a c| and |e| |x|. That interval holds for certain, so
candidates outside of what is asked go unscored and the rest are scored exactly, in integers. One bit a part leaves some 0.6
of |x|; the residual x - a c has a code and an alignment of its own, and so on, so that each stage narrows the interval for
those that the stage before could not rule out.

Anchors are a stated part of the rows. They and the candidates are dealt as a grid: a task holds one block of candidates,
brought to it once, and meets the anchor blocks of its row of the grid one after another.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import written

CANDIDATES, ANCHORS = 1 << 19, 1 << 15  # numbers in a block of candidates and of anchors; a row counts its parts and one more
ANCHOR_BLOCKS = 128  # that a task meets
BITS = 6  # of a query's part
STAGES = 4  # codes of a vector, each of what the one before left


def integer_rows(embeddings: DataFrame, label: Column, scale: float = 256.0) -> DataFrame:
    """(vec_id, label, vector): floor(scale * x) of every component.

    Rows without an id or a label, and vectors that are null or hold a null or non-finite component, go. An empty vector stays;
    it scores 0 with other empty ones.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull() & finite)
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("vector"),
    )


@lru_cache
def _signs(dims: int) -> np.ndarray:
    return np.random.default_rng(dims).choice([-1.0, 1.0], (3, dims))


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Rows turned by one orthogonal map of their number of dimensions, filled up to a power of two: signs and Hadamard, thrice."""
    many, dims = vectors.shape
    full = 1 << max(0, dims - 1).bit_length()
    turned = np.zeros((many, full))
    turned[:, :dims] = vectors
    for signs in _signs(full):
        turned *= signs
        width = 1
        while width < full:
            pairs = turned.reshape(many, full // (2 * width), 2, width)
            turned = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(many, full)
            width *= 2
    return turned / full**1.5


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    short = -bits.shape[1] % 64
    padded = np.pad(bits, ((0, 0), (0, short)))
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


class Codes:
    """Codes of some vectors, one stage after another: signs of what the stages before left, alignment, and what is left then."""

    def __init__(self, vectors: np.ndarray):
        left = rotated(vectors)
        self.parts = left.shape[1]
        self.length = np.sqrt(np.square(left).sum(axis=1))
        self.words, self.align, self.rest = [], [], []
        for _ in range(STAGES):
            signs = np.where(left > 0, 1.0, -1.0) / math.sqrt(self.parts)
            align = (left * signs).sum(axis=1)
            left -= align[:, None] * signs
            self.words.append(packed(signs > 0))
            self.align.append(align)
            self.rest.append(np.sqrt(np.square(left).sum(axis=1)))


class Query:
    """A turned query as bit planes: parts are low + step * (0 .. 2 ** BITS - 1), and what the rounding left."""

    def __init__(self, turned: np.ndarray):
        self.low = float(turned.min(initial=0))
        self.step = (float(turned.max(initial=0)) - self.low) / (2**BITS - 1) or 1.0
        levels = np.clip(np.rint((turned - self.low) / self.step), 0, 2**BITS - 1).astype(np.int64)
        rounded = self.low + self.step * levels
        self.planes = packed((levels[None, :] >> np.arange(BITS)[:, None]) & 1 == 1)
        # Met with a code, all ones counts its positive parts and plane b adds its step times 2 ** b.
        self.planes = np.vstack([packed(np.ones((1, len(turned)), dtype=bool)), self.planes])
        self.weights = np.array([self.low, *(self.step * 2.0**b for b in range(BITS))])
        self.total, self.parts = float(rounded.sum()), len(turned)
        self.square = float(np.square(rounded).sum())
        self.left = float(np.sqrt(np.square(turned - rounded).sum()))

    def stage(self, codes: Codes, stage: int, which: np.ndarray, middle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The estimate after one more stage for the codes `which`, and how far off it can be."""
        counts = np.bitwise_count(codes.words[stage][which][None] & self.planes[:, None]).sum(axis=2, dtype=np.uint32)
        # Twice the sum over the positive parts, less that over all, is the product with signs of +1 and -1.
        along = (2 * (self.weights @ counts) - self.total) / math.sqrt(self.parts)
        across = np.sqrt(np.maximum(self.square - np.square(along), 0))
        length = codes.length[which]
        slack = 1e-9 * (math.sqrt(self.square) + self.left) * length + 1e-6  # of sums in doubles
        return middle + codes.align[stage][which] * along, across * codes.rest[stage][which] + self.left * length + slack


class Block:
    """Candidates by label, with their codes; scores are exact."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(labels, kind="stable")
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.codes = Codes(self.vectors)
        self.as_doubles = self.vectors.astype(np.float64)
        self.longest = float(self.codes.length.max(initial=0))

    def scores(self, query: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Exact integers: doubles hold every partial sum below 2 ** 52, 64-bit integers the others."""
        if self.longest * math.sqrt(float(np.square(query.astype(np.float64)).sum())) < 2**51:
            few = 4 * len(which) < len(self.ids)
            return (self.as_doubles[which] @ query if few else (self.as_doubles @ query)[which]).astype(np.int64)
        return self.vectors[which] @ query

    def of_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.labels, [label, label + 1]))

    def narrowed(self, which: np.ndarray, query: Query, may) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Candidates with their bounds, stage by stage; `may(low, high)` says which ones go on."""
        middle, low, high = np.zeros(len(which)), np.full(len(which), -np.inf), np.full(len(which), np.inf)
        for stage in range(STAGES):
            middle, reach = query.stage(self.codes, stage, which, middle)
            low, high = np.maximum(low, middle - reach), np.minimum(high, middle + reach)
            stays = np.flatnonzero(may(low, high))
            if len(stays) < len(which):
                which, middle, low, high = which[stays], middle[stays], low[stays], high[stays]
        return which, low, high

    def best(self, anchor: int, label: int, vector: np.ndarray, query: Query, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best of the anchor's label with another id."""
        own = self.of_label(label)
        which = own.start + np.flatnonzero(self.ids[own] != anchor)
        which, _, _ = self.narrowed(which, query, lambda low, high: high >= kth(low, k))
        return self._first(which, self.scores(vector, which), k)

    def within(self, label: int, vector: np.ndarray, query: Query, bounds: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each (least, most) the k best of other labels with a score in it."""
        own = self.of_label(label)
        other = np.concatenate([np.arange(own.start), np.arange(own.stop, len(self.ids))])

        def each(low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
            """Per range who may be among its k best: as many as k that surely lie in it set the bar."""
            may = []
            for least, most in bounds:
                bar = max(least, kth(low[(low >= least) & (high <= most)], k))
                may.append((high >= bar) & (low <= most))
            return may

        other, low, high = self.narrowed(other, query, lambda low, high: np.logical_or.reduce(each(low, high)))
        exact = self.scores(vector, other)
        found = []
        for (least, most), may in zip(bounds, each(low, high), strict=True):
            kept = np.flatnonzero(may & (exact >= least) & (exact <= most))
            found.append(self._first(other[kept], exact[kept], k))
        return found

    def _first(self, which: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        first = np.lexsort((self.ids[which], -scores))[:k]
        return self.ids[which[first]], scores[first]


def kth(values: np.ndarray, k: int) -> float:
    """The k-th largest value, or what all exceed if there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def negative_range(positive: int) -> tuple[int, int]:
    """Least and most score s with 50 * positive <= 100 * s <= 95 * positive."""
    return -(-50 * positive // 100), 95 * positive // 100


def _numbered(rows: DataFrame, numbers: int, name: str) -> tuple[DataFrame, int]:
    """Rows with a block number, and how many blocks: rows have a number of their own, so that repeated ones spread too."""
    kept = written(rows.withColumn("number", F.monotonically_increasing_id()), name)
    whole = kept.agg(F.sum(F.size("vector") + F.lit(1).cast("long"))).first()[0] or 0
    parts = max(1, math.ceil(whole / numbers))
    return kept.withColumn(name, F.pmod(F.xxhash64("number"), F.lit(parts)).cast("int")).drop("number"), parts


def _candidate_blocks(numbered: DataFrame) -> DataFrame:
    """Candidates of one block and number of dimensions as one row of flat arrays."""
    blocks = numbered.groupBy(F.size("vector").alias("dims"), "block").agg(F.collect_list(F.struct("vec_id", "label", "vector")).alias("rows"))
    return blocks.select("dims", "block", F.col("rows.vec_id").alias("ids"), F.col("rows.label").alias("labels"), F.flatten("rows.vector").alias("flat"))


def _anchor_blocks(asked: DataFrame, parts: int) -> DataFrame:
    """Anchor blocks, each once for every candidate block. `asked` has part, anchor, label, vector and what is asked of it."""
    rest = [c for c in asked.columns if c not in ("part", "vector")]
    blocks = asked.groupBy(F.size("vector").alias("dims"), "part").agg(F.collect_list(F.struct(*rest, "vector")).alias("asked"))
    lane = F.expr(f"part div {ANCHOR_BLOCKS}").cast("int")
    return blocks.select("dims", "part", lane.alias("lane"), "asked", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("block"))


def _search(candidates: DataFrame, asked: DataFrame, kinds: str, names: list[str], answer) -> DataFrame:
    """`answer(block, anchor row, vector, query)` of every anchor and every block it meets."""
    both = candidates.withColumn("part", F.lit(-1)).unionByName(asked, allowMissingColumns=True)
    dealt = both.repartition("dims", "block", "lane").sortWithinPartitions("dims", "block", "lane", "part")
    schema = pa.schema([(n, pa.int64()) for n in names])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, key = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                dims, number, lane, part = (batch.column(n)[at].as_py() for n in ("dims", "block", "lane", "part"))
                if part == -1:
                    ids, labels, flat = (batch.column(n)[at].values.to_numpy() for n in ("ids", "labels", "flat"))
                    block, key = Block(ids, labels, flat.reshape(len(ids), dims)), (dims, number, lane)
                elif key == (dims, number, lane):  # else no candidate has this place
                    rows = batch.column("asked")[at].as_py()
                    vectors = np.array([r["vector"] for r in rows], dtype=np.int64).reshape(len(rows), dims)
                    turned = rotated(vectors)
                    found = [f for row, v, t in zip(rows, vectors, turned, strict=True) for f in answer(block, row, v, Query(t))]
                    yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(len(names))], schema=schema)

    return dealt.mapInArrow(search, kinds)


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Both tables are (vec_id, label, vector of integers). An anchor's positives are the rows of its label with other ids of the
    highest inner products; a positive's negatives the rows of other labels of the highest inner products among those of
    half to 95 % of the positive's. Ties go to smaller ids. Rows repeated whole are candidates each; anchors repeated whole are
    one, and an id that recurs with another label or vector is another anchor. Rows meet rows of their own number of
    dimensions. A positive without negatives, and an anchor without positives, has no rows; an empty table gives none.
    """
    # Anchors recur under one id only with another label or vector; `twin` tells them apart.
    given = anchors.select(F.col("vec_id").alias("anchor"), "label", "vector").distinct()
    asked, parts = _numbered(given.withColumn("twin", F.xxhash64("label", "vector")), ANCHORS, "part")
    numbered, blocks = _numbered(rows.select("vec_id", "label", "vector"), CANDIDATES, "block")
    lanes = F.sequence(F.lit(0), F.lit((parts - 1) // ANCHOR_BLOCKS))
    candidates = written(_candidate_blocks(numbered), "candidate-blocks").withColumn("lane", F.explode(lanes))

    def first(block: Block, row: dict, vector: np.ndarray, query: Query) -> Iterator[tuple]:
        for vec_id, score in zip(*block.best(row["anchor"], row["label"], vector, query, positives), strict=True):
            yield row["anchor"], row["twin"], int(vec_id), int(score)

    found = _search(candidates, _anchor_blocks(asked, blocks), "anchor long, twin long, positive long, score long", ["anchor", "twin", "positive", "score"], first)
    along = Window.partitionBy("anchor", "twin").orderBy(F.desc("score"), "positive")
    best = found.withColumn("place", F.row_number().over(along)).where(F.col("place") <= positives)
    chosen = written(best.groupBy("anchor", "twin").agg(F.sort_array(F.collect_list(F.struct("place", "positive", "score"))).alias("wanted")), "positives")

    def next_best(block: Block, row: dict, vector: np.ndarray, query: Query) -> Iterator[tuple]:
        wanted = row["wanted"]
        bounds = [negative_range(w["score"]) for w in wanted]
        for w, (ids, scores) in zip(wanted, block.within(row["label"], vector, query, bounds, negatives), strict=True):
            for vec_id, score in zip(ids, scores, strict=True):
                yield row["anchor"], row["twin"], w["place"], w["positive"], w["score"], int(vec_id), int(score)

    names = ["anchor", "twin", "place", "positive", "positive_score", "negative", "score"]
    found = _search(candidates, _anchor_blocks(asked.join(chosen, ["anchor", "twin"]), blocks), ", ".join(f"{n} long" for n in names), names, next_best)
    along = Window.partitionBy("anchor", "twin", "place").orderBy(F.desc("score"), "negative")
    ranked = found.withColumn("rank", F.row_number().over(along)).where(F.col("rank") <= negatives)
    return ranked.select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
        F.col("negative").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
