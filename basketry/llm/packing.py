"""Documents packed into sequences of one length: shortest-pack-first over the histogram of piece lengths.

A document longer than a sequence is cut into whole sequences and a rest. Only the histogram of lengths, at most
`capacity` rows, reaches the driver; there the lengths are placed longest first, each into the open packs with the most
room, and what is kept is how often each pattern of lengths occurs. Every pattern owns a range of ranks of each of its
lengths, so a piece finds its sequence from its length and its rank among the pieces of that length. Ranks are a prefix
sum over (part, length) counts plus the place within the part: no key's rows meet in one task.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import columns, texts, written
from basketry.llm.tokenizer import encoder

PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, part int, place long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

Pattern = tuple[tuple[int, int], ...]  # (length, copies), longest first


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns and how many packs have each. `histogram`: pieces of each length from 1 to `capacity`."""
    open_packs: dict[int, dict[Pattern, int]] = defaultdict(dict)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r, packs in open_packs.items() if packs), default=0)
            if room >= length:
                pattern, packs = open_packs[room].popitem()
                took, copies = min(packs, left), 1
                if packs > took:
                    open_packs[room][pattern] = packs - took
            else:
                pattern, room = (), capacity
                copies = min(left, capacity // length)
                took = left // copies
            if pattern and pattern[-1][0] == length:
                grown = (*pattern[:-1], (length, pattern[-1][1] + copies))
            else:
                grown = (*pattern, (length, copies))
            target = open_packs[room - length * copies]
            target[grown] = target.get(grown, 0) + took
            left -= took * copies
    return [(pattern, packs) for by_pattern in open_packs.values() for pattern, packs in by_pattern.items()]


@dataclass
class Slots:
    """For one length: ranks from `first` on fill `copies` places a sequence, from `sequence` and `offset` on."""

    first: np.ndarray
    copies: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def slots(patterns: list[tuple[Pattern, int]]) -> dict[int, Slots]:
    rows, rank, sequence = defaultdict(list), defaultdict(int), 0
    for pattern, packs in sorted(patterns):
        offset = 0
        for length, copies in pattern:
            rows[length].append((rank[length], copies, sequence, offset))
            rank[length] += packs * copies
            offset += length * copies
        sequence += packs
    return {length: Slots(*np.array(r, dtype=np.int64).T) for length, r in rows.items()}


def pieces(documents: DataFrame, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    """Every document's ids in pieces of `capacity` and a rest, each with its place among its part's pieces of its length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encode = TaskContext.get().partitionId(), encoder(tokenizer_path).encode
        end, places = np.array([end_id], dtype="<u4").tobytes(), defaultdict(int)
        for batch in batches:
            rows = []
            for doc_id, text in zip(*columns(batch, "doc_id", "text"), strict=True):
                ids = encode(text) + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    length = min(capacity, total - start)
                    check = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((doc_id, start, length, check, total, part, places[length]))
                    places[length] += 1
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "place")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return texts(documents).mapInArrow(cut, PIECES)


def pack(documents: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 1024) -> DataFrame:
    """The sequence and offset of every piece of every document.

    A null text is empty: its document is `end_id` alone. Documents without an id are packed like others, rows that
    repeat a doc_id are documents of their own, an empty table has no pieces. Equal lengths are ranked by part and place.
    """
    spark = documents.sparkSession
    cut = written(pieces(documents, tokenizer_path, end_id, capacity), "pieces")
    counts = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("pieces"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.withColumn("before", F.coalesce(F.sum("pieces").over(before), F.lit(0))), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("pieces").alias("n")).collect()}
    table = spark.sparkContext.broadcast(slots(shortest_pack_first(histogram, capacity)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), dtype=np.int64), np.zeros(len(rank), dtype=np.int64)
            for one in np.unique(length):
                at, own = np.flatnonzero(length == one), table.value[int(one)]
                slot = np.searchsorted(own.first, rank[at], side="right") - 1
                row, copy = np.divmod(rank[at] - own.first[slot], own.copies[slot])
                sequence[at], offset[at] = own.sequence[slot] + row, own.offset[slot] + copy * int(one)
            kept = {n: batch.column(n) for n in ("doc_id", "start")} | {"length": length.astype(np.int64)}
            kept |= {n: batch.column(n) for n in ("ids_crc32", "doc_tokens")}
            yield pa.RecordBatch.from_pydict(kept | {"sequence_id": sequence, "offset": offset})

    ranked = cut.join(counts.select("part", "length", "before"), ["part", "length"]).withColumn("rank", F.col("before") + F.col("place"))
    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(place, PACKED)
