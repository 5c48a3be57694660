"""Passages that occur more than once, found by level-wise doubling of windows of words.

Level one looks at windows of half the length sought, and of those only at the one with the least hash among all inside
each sought window: equal windows have equal least parts, so nothing is missed while about a tenth of the places move.
Only windows around a repeated half go on to the full length, and on request from there to twice that length and so on,
until none survives. At each level the hashes are counted with partial sums and joined back to their places; a passage
that a third of all documents share is many keys of moderate size, which the join splits. Text is shuffled once and
that exchange serves both sides of the second level. Where texts are equal as a whole, all their windows are repeated:
one of them is counted for the others' sake, and none of their windows is joined back.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import Words, attach, columns, discard, list_column, mixed, small_batches, texts, written

WINDOW = 35
ROWS = 500  # documents hashed at a time
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # of the two halves of a window's hash
LANES = ("high", "low")
PLACES = "doc_id long, print long, place int"
FIRST, AGAIN = "first", "again"  # roles of rows whose text other rows hold too: the one that is counted, and the rest


class Windows(Words):
    """The windows of words in some documents."""

    def __init__(self, batch: pa.RecordBatch):
        super().__init__(columns(batch, "text")[0])

    def starts(self, length: int) -> np.ndarray:
        """Where a window of `length` words of one document can start."""
        places = np.arange(len(self.document))
        return places[places + length <= self.ends[self.document]]

    def windows(self, length: int, lane: int = 0) -> np.ndarray:
        """A hash of the `length` words from each place on, by doubling; windows that leave their document mean nothing."""
        done, factor, found = 1, MULTIPLIERS[lane], mixed(self.hashes + np.uint64(lane))
        while done < length:
            step = min(done, length - done)
            later = np.zeros_like(found)
            later[: max(len(found) - step, 0)] = found[step:]
            found = found * np.uint64(pow(factor, 2 * step + 1, 2**64)) + later
            done += step
        return mixed(found)


def least_halves(words: Windows, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The starts of windows, and for each the place of the first of its halves with the least hash, again by doubling."""
    least = words.windows(math.ceil(window / 2))
    place, done, span = np.arange(len(least)), 1, window // 2 + 1
    while done < span and len(least) > 1:
        step = min(done, span - done)
        smaller = least[step:] < least[:-step]
        place = np.concatenate([np.where(smaller, place[step:], place[:-step]), place[-step:]])
        least = np.concatenate([np.where(smaller, least[step:], least[:-step]), least[-step:]])
        done += step
    starts = words.starts(window)
    return starts, place[starts]


Chosen = Callable[[Windows, pa.RecordBatch], tuple[np.ndarray, int]]


def _places(rows: DataFrame, chosen: Chosen, lanes: int = 2) -> DataFrame:
    """The places that `chosen` picks, with the hash of the window of its length in so many 64-bit lanes."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, ROWS):
            words = Windows(batch)
            at, length = chosen(words, batch)
            document = words.document[at]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(document)),
                    batch.column("print").take(pa.array(document)),
                    pa.array((at - words.begins[document]).astype(np.int32)),
                    *(pa.array(words.windows(length, lane)[at].view(np.int64)) for lane in range(lanes)),
                ],
                ["doc_id", "print", "place", *LANES[:lanes]],
            )

    return rows.mapInArrow(emit, ", ".join([PLACES, *(f"{name} long" for name in LANES[:lanes])]))


def _dealt_anew(counts: DataFrame) -> DataFrame:
    """The same rows after a shuffle of their own: a join splits a hot key only where both sides come straight from one."""
    return counts.repartition(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _repeated(places: DataFrame, name: str, among: DataFrame | None = None) -> DataFrame:
    """(doc_id, print, places): those whose window occurs more than once in `among`, or else in `places` themselves."""
    lanes = [lane for lane in LANES if lane in places.columns]
    counts = (places if among is None else among).groupBy(*lanes).agg(F.count(F.lit(1)).alias("n"))
    often = _dealt_anew(counts.where(F.col("n") > 1).select(*lanes))
    return places.join(often, lanes).groupBy("doc_id", "print").agg(F.collect_set("place").alias(name))


def _roles(rows: DataFrame) -> DataFrame:
    """(doc_id, print, role) of the rows whose text another row holds too; texts are told apart by two hashes from different
    seeds: Spark hashes a column with the hash of those before it as the seed, so the seed has to come first."""
    prints = rows.select("doc_id", "print", F.xxhash64(F.lit(1), "text").alias("other"))
    held = prints.groupBy("print", "other").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least")).where(F.col("n") > 1)
    role = F.when(F.col("doc_id").eqNullSafe(F.col("least")), FIRST).otherwise(AGAIN)
    return prints.join(_dealt_anew(held), ["print", "other"]).groupBy("doc_id", "print").agg(F.max(role).alias("role"))


def _listed(words: Windows, batch: pa.RecordBatch, name: str) -> np.ndarray:
    """Whether each place of the documents is in their list column `name`."""
    marked = np.zeros(len(words.document), dtype=bool)
    for begin, places in zip(words.begins, batch.column(name), strict=True):
        if places.is_valid:
            marked[begin + places.values.to_numpy()] = True
    return marked


def _whole(words: Windows, batch: pa.RecordBatch) -> np.ndarray:
    """Whether each place of the documents lies in a text that another row holds too."""
    return np.asarray(batch.column("role").is_valid())[words.document]


def repeated_starts(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, print, text, role, starts): each row with the starts of its windows that occur anywhere else.

    Rows with a role have a text that another row holds too; all their windows are repeated and `starts` is null.
    """
    rows = texts(documents).withColumn("print", F.xxhash64("text"))

    def halves(words: Windows, batch: pa.RecordBatch) -> tuple[np.ndarray, int]:
        place = least_halves(words, window)[1]  # rises with the start
        return place[np.flatnonzero(np.diff(place, prepend=-1))], math.ceil(window / 2)

    def wholes(words: Windows, batch: pa.RecordBatch) -> tuple[np.ndarray, int]:
        starts, place = least_halves(words, window)
        return starts[(_listed(words, batch, "halves") | _whole(words, batch))[place]], window

    half = written(_places(rows, halves, lanes=1), "halves")
    found = attach(_repeated(half, "halves"), _roles(rows), "doc_id", "print")
    # Rows with a role keep none of their places: the role says that all of them are repeated.
    found = found.withColumn("halves", F.when(F.col("role").isNull(), F.col("halves")).otherwise(F.array().cast("array<int>")))
    found = written(found, "repeated-halves")
    discard(half)  # as large as all other tables together
    met = attach(rows, found, "doc_id", "print")
    some = met.where(F.col("halves").isNotNull())
    own = _places(some.where(F.col("role").isNull()), wholes)
    among = _places(some.where(F.col("role").isNull() | (F.col("role") == FIRST)), wholes)
    return attach(met, _repeated(own, "starts", among), "doc_id", "print").select("doc_id", "print", "text", "role", "starts")


def longest_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, print, length, starts): the windows of length window, twice that, four times that, ... that occur again.

    A window goes on to twice the length if both its halves are repeated; the last level is the one without survivors.
    """
    rows = texts(documents).withColumn("print", F.xxhash64("text"))
    found, length = [], window

    def all_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, ROWS):
            words = Windows(batch)
            marked = _listed(words, batch, "starts")
            whole = words.starts(window)
            marked[whole] |= _whole(words, batch)[whole]
            lists = list_column((np.flatnonzero(marked[a:b]) for a, b in zip(words.begins, words.ends, strict=True)), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("print"), lists], ["doc_id", "print", "starts"])

    level = repeated_starts(documents, window).mapInArrow(all_starts, "doc_id long, print long, starts array<int>")
    level = written(level.where(F.size("starts") > 0).distinct(), "repeats")
    while not level.isEmpty():
        found.append(level.select("doc_id", "print", F.lit(length).alias("length"), "starts"))

        def doubled(words: Windows, batch: pa.RecordBatch, length: int = length) -> tuple[np.ndarray, int]:
            marked, starts = _listed(words, batch, "starts"), words.starts(2 * length)
            return starts[marked[starts] & marked[starts + length]], 2 * length

        going_on = attach(rows, level, "doc_id", "print").where(F.col("starts").isNotNull())
        length *= 2
        level = written(_repeated(_places(going_on, doubled), "starts"), "repeats")
    if not found:
        return level.select("doc_id", "print", F.lit(window).alias("length"), "starts")
    result = found[0]
    for more in found[1:]:
        result = result.union(more)
    return result


def dedup_substrings(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, print, n_words, n_removed, kept): each text without the words that a repeated window covers.

    Words are what ASCII white space separates; a window is `window` consecutive words of one row that start anywhere
    else too, in the same row or another. Windows are judged on the input. The words that stay are joined by one space.
    Null and empty texts have no words. Every row is a text of its own, so repeated rows lose all windows. Windows are told
    apart by 128-bit hashes; of halves 64 bits choose which windows are looked at. An empty table gives no rows.
    """

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, ROWS):
            words = Windows(batch)
            edges = np.zeros(len(words.document) + 1, dtype=np.int32)
            starts = np.flatnonzero(_listed(words, batch, "starts"))
            edges[starts] += 1
            edges[starts + window] -= 1
            long = words.ends - words.begins >= window
            stays = (np.cumsum(edges)[:-1] == 0) & ~(_whole(words, batch) & long[words.document])
            kept, removed = [], []
            for text, begin, end in zip(columns(batch, "text")[0], words.begins, words.ends, strict=True):
                own, mask = text.encode("utf-8", "surrogatepass").split(), stays[begin:end]
                removed.append(int(len(own) - mask.sum()))
                chosen = own if not removed[-1] else compress(own, mask.tolist())
                kept.append(b" ".join(chosen).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("print"),
                    pa.array(words.ends - words.begins, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                ["doc_id", "print", "n_words", "n_removed", "kept"],
            )

    return repeated_starts(documents, window).mapInArrow(remove, "doc_id long, print long, n_words long, n_removed long, kept string")
