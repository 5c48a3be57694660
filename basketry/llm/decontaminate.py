"""Benchmark passages in documents: a prefix-filtered set join of benchmark windows with all documents.

A window is `WINDOW` consecutive words of an item (a shorter item is one window). Its tokens are its shingles. To hold a
window a document must hold all its shingles, so one, the rarest over all documents, is the necessary prefix, and a
window with a shingle that no document holds is given up. Documents' shingles meet the prefixes; length and position
bounds place the window, and its words are compared in place. Windows are the query set: they go out in blocks of a
stated size, so a broadcast never grows with the benchmark and no document text is shuffled.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketry.llm.common import attach, lower_ascii, texts, written

WINDOW, SHINGLE = 10, 5
BLOCK = 50_000  # windows, or shingles, in one broadcast: some 20 MB
# Fixed value: everything but digits, a-z and non-ASCII characters separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), SEPARATORS), "")


def _shingle(of: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*(of[at + i] for i in range(size)))


def _shingles(rows: DataFrame, size: int, *keep: str) -> DataFrame:
    """One row for each run of `size` words, with its place."""
    long_enough = rows.where(F.size("words") >= size)
    places = long_enough.select(*keep, "words", F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("place"))
    return places.withColumn("shingle", _shingle(F.col("words"), F.col("place"), size))


def _blocks(rows: DataFrame, key: Column) -> list[DataFrame]:
    """`rows` dealt by `key` into parts of about BLOCK rows, each marked for broadcast."""
    parts = math.ceil(rows.count() / BLOCK)
    return [F.broadcast(rows.where(F.pmod(key, F.lit(parts)) == i)) for i in range(parts)]


def windows(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window_id, words, length) and the items that hold them (window_id, item_id as text)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text").cast("string")).alias("all"))
    items = items.where(F.size("all") > 0)
    last = F.greatest(F.size("all") - window, F.lit(0))
    cut = items.select("item_id", "all", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    cut = cut.select("item_id", F.slice("all", F.col("at") + 1, window).alias("words"))
    cut = cut.withColumn("window_id", F.unhex(F.md5(F.array_join("words", " "))))
    distinct = cut.dropDuplicates(["window_id"]).select("window_id", "words", F.size("words").alias("length"))
    return written(distinct, "windows"), written(cut.select("window_id", "item_id").distinct(), "window-items")


def _prefixes(rows: DataFrame, cut: DataFrame, size: int) -> DataFrame:
    """Windows with their rarest shingle and its place in them."""
    own = _shingles(cut, size, "window_id", "length")
    known = own.select("shingle").distinct()
    counts = [
        _shingles(rows, size).select("shingle").join(block, "shingle").groupBy("shingle").agg(F.count(F.lit(1)).alias("found"))
        for block in _blocks(known, F.col("shingle"))
    ]
    if not counts:
        return own.select("window_id", "words", "length", "place", "shingle").limit(0)
    found = written(reduce(DataFrame.union, counts), "shingle-counts")
    ordered = own.join(found, "shingle", "left").groupBy("window_id").agg(
        F.min(F.struct(F.coalesce("found", F.lit(0)).alias("found"), "shingle", "place")).alias("rarest")
    )
    return ordered.where(F.col("rarest.found") > 0).join(cut, "window_id").select("window_id", "words", "length", "rarest.place", "rarest.shingle")


def hits(documents: DataFrame, cut: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, print, start, end, window_id) of every occurrence of a window; `end` is exclusive."""
    rows = texts(documents).select("doc_id", F.xxhash64("text").alias("print"), words(F.col("text")).alias("words"))
    found = []
    for size in sorted({min(r["length"], shingle) for r in cut.select("length").distinct().collect()}):
        of_size = cut.where(F.least("length", F.lit(shingle)) == size)
        prefixes = written(_prefixes(rows, of_size, size), "prefixes")
        for block in _blocks(prefixes, F.xxhash64("window_id")):
            sought = block.select(
                "window_id", F.col("words").alias("sought"), "length", F.col("place").alias("inside"), "shingle"
            )
            start = F.col("place") - F.col("inside")
            met = _shingles(rows, size, "doc_id", "print").join(F.broadcast(sought), "shingle")
            met = met.where((start >= 0) & (start + F.col("length") <= F.size("words")))
            met = met.where(F.slice("words", start + 1, F.col("length")) == F.col("sought"))
            found.append(met.select("doc_id", "print", start.alias("start"), (start + F.col("length")).alias("end"), "window_id"))
    if not found:
        return documents.sparkSession.createDataFrame([], "doc_id long, print long, start int, end int, window_id binary")
    return written(reduce(DataFrame.union, found), "hits")


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, print, n_words, n_hit, items, contaminated): how much of each document is benchmark text.

    A word inside any occurrence of a window is hit; `items` are the ids, as sorted texts, of the items with occurring
    windows. Null and empty texts have no words, on either side. A benchmark row without an id makes hits but no item;
    rows that repeat an item_id are one item. Document rows that repeat a doc_id are judged each by its own text. Empty
    tables give no rows, or rows without hits.
    """
    cut, held_by = windows(benchmark, window)
    found = hits(documents, cut, shingle)
    along = Window.partitionBy("doc_id", "print").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.select("doc_id", "print", "start", "end").distinct()
    reached = F.greatest(F.col("start"), F.coalesce(F.max("end").over(along), F.lit(0)))
    covered = spans.select("doc_id", "print", F.greatest(F.col("end") - reached, F.lit(0)).alias("new"))
    covered = covered.groupBy("doc_id", "print").agg(F.sum("new").alias("n_hit"))
    named = found.select("doc_id", "print", "window_id").distinct().join(held_by, "window_id")
    named = named.groupBy("doc_id", "print").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    rows = texts(documents).select("doc_id", F.xxhash64("text").alias("print"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    judged = attach(attach(rows, covered, "doc_id", "print"), named, "doc_id", "print")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    none = F.array().cast("array<string>")
    return judged.select(
        "doc_id", "print", "n_words", n_hit.alias("n_hit"), F.coalesce("items", none).alias("items"), (n_hit > 0).alias("contaminated")
    )
