"""Lines repeated across documents, kept once: levelled sorted runs of line hashes.

Documents come in batches of falling doc_id. A batch sums its own lines first: per hash how many of its documents hold the line,
and the largest of them. It is then merge-anti-joined with the runs: what no run holds is new and becomes a run of its own, whose
keeper is final, as later batches have smaller ids; what a run holds already only adds to the line's count, in a tally beside the
runs. `fanout` runs of one level are compacted into one of the next. All runs, tallies and batches have the same hash
partitions and lie sorted, so that a merge moves nothing. Which lines are repeated, and who keeps them, is read from the
runs with their tallies.

There are more batches in a larger table, by the logarithm of its rows: every batch is merged with all runs, so a fixed
size of batches would make that work grow with the square of the table. Everything is DataFrame functions; lines are hashed once
to count them, and text is shuffled once, to meet the places of its dropped lines.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import WHITE, attach, discard, lower_ascii, new_folder, texts
from basketry.session import materialise
from basketry.store import discard as discard_checkpoints

NO_ID = -(2**63)  # rows without an id rank below all others
LEAST_BATCHES, ROWS = 4, 100_000  # batches of a small table; one more for every doubling of so many rows


class LineRuns:
    """Sorted runs (hash, keeper and, where batches have it, docs) in levels; every hash lies in one run only."""

    def __init__(self, spark: SparkSession, fanout: int = 3):
        self.spark, self.fanout, self.compactions = spark, fanout, 0
        self.partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = [[]]
        self.tallies: list[DataFrame] = []

    def _sorted(self, run: DataFrame) -> DataFrame:
        return run.repartition(self.partitions, "hash").sortWithinPartitions("hash")

    def _unseen(self, batch: DataFrame) -> DataFrame:
        runs = [run for level in self.levels for run in level]
        return reduce(lambda left, run: left.join(run.select("hash").hint("merge"), "hash", "left_anti"), runs, batch)

    def add(self, batch: DataFrame) -> None:
        """Add a batch (unique hashes): unseen rows as a run, counts of the others as a tally; compact levels that are full."""
        batch = materialise(self._sorted(batch))[0]
        new = materialise(self._unseen(batch))[0]
        if "docs" in batch.columns:
            again = batch.join(new.select("hash").hint("merge"), "hash", "left_anti").select("hash", "docs")
            self.tallies.append(materialise(again)[0])
        discard_checkpoints(batch)
        self.levels[0].append(new)
        for depth in range(len(self.levels)):
            if len(self.levels[depth]) >= self.fanout:
                if depth + 1 == len(self.levels):
                    self.levels.append([])
                merged = materialise(self._sorted(reduce(DataFrame.union, self.levels[depth])))[0]
                discard_checkpoints(*self.levels[depth])
                self.levels[depth + 1].append(merged)
                self.levels[depth] = []
                self.compactions += 1

    def all(self) -> DataFrame:
        return reduce(DataFrame.union, [run for level in self.levels for run in level])

    def held_by(self, least: int) -> DataFrame:
        """(hash, keeper) of the lines that at least so many documents of all batches hold."""
        tally = reduce(DataFrame.union, self.tallies).groupBy("hash").agg(F.sum("docs").alias("more"))
        both = [run.join(self._sorted(tally).hint("merge"), "hash", "left") for level in self.levels for run in level]
        counted = reduce(DataFrame.union, both)
        return counted.where(F.col("docs") + F.coalesce("more", F.lit(0)) >= least).select("hash", "keeper")

    def close(self) -> None:
        """Delete the runs; what was made from them must be written by then."""
        discard_checkpoints(*(run for level in self.levels for run in level), *self.tallies)


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(WHITE)))


def _batch_edges(rows: DataFrame, batches: int | None) -> list[int]:
    """Falling doc_ids at which batches of about equally many rows begin, but for the first."""
    if batches is None:
        batches = LEAST_BATCHES + int(math.log2(1 + rows.count() / ROWS))
    shares = [i / batches for i in range(batches - 1, 0, -1)]
    bounds = (rows.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] or []) if shares else []
    return sorted(set(bounds), reverse=True)


def line_runs(documents: DataFrame, batches: int | None = None, min_chars: int = 20, fanout: int = 3) -> LineRuns:
    """Runs of the hashes of all lines of at least `min_chars`, built batch by batch."""
    spark = documents.sparkSession
    rows = texts(documents).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    edges = _batch_edges(rows, batches)
    # The batch of a row: how many of the falling edges its id lies below.
    batch = reduce(lambda total, edge: total + (F.col("doc_id") < edge).cast("int"), edges, F.lit(0)).alias("batch")
    keys = F.filter(F.transform(_lines(F.col("text")), _key), lambda key: F.char_length(key) >= min_chars)
    hashes = F.explode(F.array_distinct(F.transform(keys, F.md5))).alias("hash")
    folder = new_folder(spark, "line-hashes")
    rows.select(batch, "doc_id", hashes).withColumn("hash", F.unhex("hash")).write.partitionBy("batch").parquet(folder)
    held = spark.read.schema("doc_id long, hash binary, batch int").parquet(folder)
    held.written_to = folder
    runs = LineRuns(spark, fanout)
    for number in range(len(edges) + 1):
        own = held.where(F.col("batch") == number).groupBy("hash", "doc_id").agg(F.lit(1))  # rows of one id are one document
        runs.add(own.groupBy("hash").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("keeper")))
    discard(held)
    return runs


def dedup_lines(documents: DataFrame, *keep: Column, batches: int | None = None, min_docs: int = 3, min_chars: int = 20) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept, `keep` columns): the text without the lines another document keeps.

    A line's key is the line without ASCII white space at its ends and with A-Z lowered. Keys of at least `min_chars`
    code points in at least `min_docs` documents lose all their lines except in the largest doc_id that holds them. Rows of one
    doc_id are one document, which keeps or loses a line in all its rows; rows without an id are one that ranks below all ids.
    A null or empty text is one empty line. A document of which no line stays has the empty text. An empty table gives no rows.
    """
    runs = line_runs(documents, batches, min_chars)
    repeated = materialise(runs.held_by(min_docs))[0]
    runs.close()
    rows = texts(documents, *keep).withColumn("own", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("print", F.xxhash64("text"))
    placed = rows.select("own", "print", F.posexplode(_lines(F.col("text"))).alias("place", "line"))
    placed = placed.select("own", "print", "place", _key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    placed = placed.select("own", "print", "place", F.unhex(F.md5("key")).alias("hash"))
    dropped = placed.join(repeated, "hash").where(F.col("own") != F.col("keeper"))
    dropped = dropped.groupBy("own", "print").agg(F.collect_set("place").alias("dropped"))
    none = F.array().cast("array<int>")
    joined = attach(rows, dropped, "own", "print").withColumns(
        {"lines": _lines(F.col("text")), "dropped": F.coalesce("dropped", none)}
    )
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    kept = F.array_join(F.transform(places, lambda i: F.get("lines", i)), "\n")
    return joined.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("dropped").cast("long").alias("n_dropped"),
        F.when(F.size("dropped") == 0, F.col("text")).otherwise(kept).alias("kept"),
        *rows.columns[2:-2],
    )
