"""Near-duplicate documents: one-permutation hashing, banded buckets, star-shaped candidates, exact confirmation.

All shingles of a document are hashed once; the hash range is cut into bins whose least values are the signature, and an
empty bin borrows from the first non-empty one in an order of its own (optimal densification). Documents with equal sets
are one node. Nodes with an equal band of the signature share a bucket, and a bucket's hub, its most central node, is
paired with the others: as many pairs as members. Pairs are confirmed on full sets. A bucket whose nodes are not all
linked by then goes another round with more hubs, until every two nodes of a bucket that could still join two groups have
been compared. Before a pair becomes a row its parity bits, made from full sets as well, give a lower bound on the number of
shingles that only one of the two has; a pair is left out only if that bound alone puts it below the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import Words, attach, columns, counted, list_column, mixed, small_batches, texts, written
from basketry.llm.components import components, merged

BANDS, ROWS = 24, 4
BINS = BANDS * ROWS
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SKETCH = "doc_id long, print long, n_shingles long, node binary, bands array<long>"
SETS = "node binary, shingles array<long>, bits array<long>"
BITS = 1024  # the parity of the number of a set's hashes in each of so many ranges
MORE_HUBS = 8  # times as many in each round
# For every bin, the order in which it looks for a value when it has none.
BORROWING = np.random.default_rng(0).permuted(np.tile(np.arange(BINS), (BINS, 1)), axis=1)


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Per text the distinct runs of `size` words as sorted hashes; fewer words are one run, no words none."""
    words = Words(texts, lower=True)
    hashes = mixed(words.hashes)

    def runs(length: int) -> np.ndarray:
        found = np.full(len(hashes), length, dtype=np.uint64)
        for i in range(length):
            till = max(len(hashes) - i, 0)
            found[:till] = found[:till] * MULTIPLIER + hashes[i:]
        return mixed(found)

    by_length = {size: runs(size)}
    sets = []
    for begin, end in zip(words.begins, words.ends, strict=True):
        length = min(size, end - begin)
        if length not in by_length:
            by_length[length] = runs(length)
        sets.append(np.unique(by_length[length][begin : end - length + 1]) if length else np.zeros(0, dtype=np.uint64))
    return sets


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least hash of every bin. Bins follow the order of hashes, so it is the first of each in a sorted array."""
    bins = ((hashes >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    values, filled = np.zeros(BINS, dtype=np.uint64), np.zeros(BINS, dtype=bool)
    values[bins[first]], filled[bins[first]] = hashes[first], True
    empty = np.flatnonzero(~filled)
    if len(empty):
        values[empty] = values[BORROWING[empty, filled[BORROWING[empty]].argmax(axis=1)]]
    return values


def band_keys(values: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        keys = mixed(keys * MULTIPLIER + values.reshape(BANDS, ROWS)[:, i])
    return keys.view(np.int64)


def parities(hashes: np.ndarray) -> np.ndarray:
    """Whether each range holds an odd number of the hashes. Every bit in which two sets differ stands for at least one hash
    of its own that only one of them has."""
    counts = np.bincount((hashes % np.uint64(BITS)).astype(np.int64), minlength=BITS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _node(hashes: np.ndarray) -> bytes:
    return blake2b(hashes.tobytes(), digest_size=16).digest()


def sketches(documents: DataFrame, size: int) -> DataFrame:
    """Every row with the number of its shingles, the digest of its set, and its band keys."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1000):
            sets = shingle_sets(columns(batch, "text")[0], size)
            keys = [band_keys(signature(s)) if len(s) else np.zeros(0, dtype=np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("print"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_node(s) if len(s) else None for s in sets], pa.binary()),
                    list_column(keys, pa.int64()),
                ],
                ["doc_id", "print", "n_shingles", "node", "bands"],
            )

    return texts(documents).withColumn("print", F.xxhash64("text")).mapInArrow(sketch, SKETCH)


def _sets(documents: DataFrame, holders: DataFrame, size: int) -> DataFrame:
    """(node, shingles, bits) read from one row of each node; `holders` is (doc_id, print, node)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1000):
            sets = shingle_sets(columns(batch, "text")[0], size)
            lists = [list_column((s.view(np.int64) for s in sets), pa.int64()), list_column(map(parities, sets), pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("node"), *lists], ["node", "shingles", "bits"])

    rows = texts(documents).withColumn("print", F.xxhash64("text"))
    known = rows.where(F.col("doc_id").isNotNull()).join(holders, ["doc_id", "print"])
    nameless = rows.where(F.col("doc_id").isNull()).join(holders.where(F.col("doc_id").isNull()).drop("doc_id"), "print").select(known.columns)
    met = known.union(nameless).groupBy("doc_id", "print", "node").agg(F.min("text").alias("text"))
    return met.select("node", "text").mapInArrow(read, SETS)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of `pairs` whose sets overlap by `percent` of their union."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    other = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    met = pairs.join(other, "b").join(one, "a")
    both = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    union = F.size("of_a").cast("long") + F.size("of_b") - both
    return met.where(100 * both >= percent * union).select("a", "b")


def _links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """The components of all nodes linked through a shared bucket. `members`: (key, node, n, weight, bits)."""
    order = Window.partitionBy("key").orderBy(F.desc("weight"), "node")
    differing = sum((F.bit_count(F.col("bits")[i].bitwiseXOR(F.col("hub_bits")[i])) for i in range(BITS // 64)), F.lit(0))
    ahead = (F.col("hub_weight") > F.col("weight")) | ((F.col("hub_weight") == F.col("weight")) & (F.col("hub") < F.col("node")))
    # Sets that share `percent` of their union have (100 - percent) of each (100 + percent) of their sizes' sum in one alone.
    alike = (100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")) & ((100 + percent) * differing <= (100 - percent) * (F.col("n") + F.col("hub_n")))
    waiting, hubs_each = members.withColumn("root", F.col("node")), 1
    tested, roots, rows = None, None, 1
    while rows:
        hubs = waiting.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= hubs_each)
        hubs = written(hubs.select("key", *(F.col(c).alias(f"hub_{c}") for c in ("n", "weight", "bits", "root")), F.col("node").alias("hub")), "hubs")
        pairs = waiting.join(hubs, "key").where((F.col("root") != F.col("hub_root")) & ahead & alike)
        pairs = pairs.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs, many = counted(pairs, "pairs")
        if many:
            tested = pairs if tested is None else tested.union(pairs)
            found, linked = counted(_confirmed(pairs, sets, percent), "links")
            if linked:
                roots = components(found) if roots is None else merged(roots, found)
        left = waiting.join(hubs.select("key", F.col("hub").alias("node")), ["key", "node"], "left_anti").drop("root")
        left = attach(left, roots, "node") if roots is not None else left.withColumn("root", F.lit(None).cast("binary"))
        left = left.withColumn("root", F.coalesce("root", "node"))
        ends = left.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"))
        waiting, rows = counted(left.join(ends.where(F.col("least") != F.col("most")).select("key"), "key"), "waiting")
        hubs_each *= MORE_HUBS
    return roots


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, print, n_shingles, component_id, root): which documents are linked, directly or through others.

    A document's set is its distinct runs of `size` words, words being what ASCII white space separates with A-Z lowered; a
    shorter text is one run. Two documents are linked if their sets share `percent` of their union. `component_id` is the
    smallest doc_id reachable. Null and empty texts have no set and are linked with nothing. Rows without an id take part;
    a component of such rows alone has no id, but `root` tells it apart too. Repeated rows are documents of their own, linked as equal sets are.
    """
    rows = written(sketches(documents, size), "sketches")
    full = rows.where(F.col("n_shingles") > 0)
    nodes = full.groupBy("node").agg(
        F.min("doc_id").alias("least"),
        F.min(F.struct("doc_id", "print")).alias("holder"),
        F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands"),
    )
    nodes = written(nodes, "nodes")
    spread = nodes.select("node", "n", F.explode("bands").alias("key"))
    shared = spread.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > 1)
    members, many = counted(spread.join(shared, "key"), "members")
    component = nodes.select("node", "least", F.col("node").alias("root"))
    if many:
        central = members.groupBy("node").agg(F.sum("held").alias("weight"))
        holders = nodes.join(central.select("node"), "node").select("holder.doc_id", "holder.print", "node")
        sets = written(_sets(documents, holders, size), "sets")
        members = written(members.drop("held").join(central.join(sets.select("node", "bits"), "node"), "node"), "members")
        roots = _links(members, sets, percent)
        if roots is not None:
            component = attach(component.drop("root"), roots, "node").withColumn("root", F.coalesce("root", "node"))
    named = component.groupBy("root").agg(F.min("least").alias("component_id"))
    named = component.join(named, "root").select("node", "component_id", "root")
    linked = full.join(named, "node").select("doc_id", "print", "n_shingles", "component_id", "root")
    alone = rows.where(F.col("n_shingles") == 0).select("doc_id", "print", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("binary").alias("root"))
    return linked.union(alone)
