"""What several operators share: written intermediate tables, null-safe joins, ASCII words and rows as Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager, nullcontext
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from basketry.session import shared_folder
from basketry.store import delete

# The white space and the letters that the operators' contracts name.
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path, not yet made, in the shared folder that all executors reach."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_cleaned(spark: SparkSession) -> Iterator[None]:
    """Queries run in this block delete their shuffle files when they end; a session without that setting keeps them."""
    before = spark.conf.get(CLEANUP, None)
    if before is None:
        yield
        return
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def written(df: DataFrame, name: str, clean: bool = False, codec: str = "snappy") -> DataFrame:
    """Write `df` once to the shared folder and go on from the files: lineage ends there, so losing an executor costs no
    more than the tasks it ran. With `clean` what it shuffled is deleted too, which is for tables that nobody else computes."""
    folder = new_folder(df.sparkSession, name)
    with shuffles_cleaned(df.sparkSession) if clean else nullcontext():
        df.write.option("compression", codec).parquet(folder)
    table = df.sparkSession.read.schema(df.schema).parquet(folder)
    table.written_to = folder
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that `written` gave, once all that was made from them is itself written."""
    for table in tables:
        delete(table.sparkSession, table.written_to)


def counted(df: DataFrame, name: str, clean: bool = False, codec: str = "snappy") -> tuple[DataFrame, int]:
    """`written`, and how many rows that wrote."""
    seen = Observation()
    kept = written(df.observe(seen, F.count(F.lit(1)).alias("rows")), name, clean, codec)
    return kept, seen.get["rows"]


def attach(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Left join on `keys`, in which two nulls are equal, so that rows without an id keep their results."""
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    match = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    return left.join(renamed, match, "left").drop(*(f"_{k}" for k in keys))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; pure ASCII goes through the faster general function."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def texts(documents: DataFrame, *keep: Column) -> DataFrame:
    """doc_id, text and the `keep` columns, whatever else the table holds; a null text becomes the empty one."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *keep)


def columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(n).to_pylist() for n in names]


def ascii_words(text: str | None) -> list[bytes]:
    """Words in UTF-8 with A-Z lowered: both steps of `bytes` touch ASCII only, as the contracts ask."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def white(data: np.ndarray) -> np.ndarray:
    """Which UTF-8 bytes are ASCII white space."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of UTF-8 bytes begin and end; ASCII white space parts them."""
    edges = np.flatnonzero(np.diff(white(data).view(np.int8), prepend=1, append=1))
    return edges[::2], edges[1::2]


LONGEST = 1 << 18  # bytes hashed in one go; a longer word is hashed by the library, whatever surrounds it
BYTE_VALUES = np.random.default_rng(2).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15


def powers(base: int, upto: int) -> np.ndarray:
    factors = np.full(upto + 1, base, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


POWERS, INVERSES = powers(BASE, LONGEST), powers(pow(BASE, -1, 2**64), LONGEST)


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial of random values of its bytes, from running sums over many words at once."""
    found, at = np.empty(len(begins), dtype=np.uint64), 0
    while at < len(begins):
        first = begins[at]
        till = int(np.searchsorted(ends, first + LONGEST, side="right"))
        if till <= at:
            found[at] = xxh3_64_intdigest(data[first : ends[at]].tobytes())
            at += 1
            continue
        part = data[first : ends[till - 1]]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[part] * POWERS[: len(part)], out=sums[1:])
        begin, end = begins[at:till] - first, ends[at:till] - first
        found[at:till] = (sums[end] - sums[begin]) * INVERSES[begin]
        at = till
    return mixed(found)


class Words:
    """The words of some texts, one after another: hashes, the number of their text, and where each text begins and ends."""

    def __init__(self, texts: list[str | None], lower: bool = False):
        encoded = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
        joined = b"\n".join(encoded)
        self.data = np.frombuffer(joined.lower() if lower else joined, dtype=np.uint8)
        self.first, self.last = word_spans(self.data)
        lengths = np.array([len(e) + 1 for e in encoded], dtype=np.int64)
        self.ends = np.searchsorted(self.first, np.cumsum(lengths))
        self.begins = np.concatenate([[0], self.ends]).astype(np.int64)[:-1]
        self.document = np.repeat(np.arange(len(texts)), self.ends - self.begins)

    @cached_property
    def hashes(self) -> np.ndarray:
        return word_hashes(self.data, self.first, self.last)


def list_column(rows: Iterable[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    rows = list(rows)
    ends = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) for r in rows], out=ends[1:])
    flat = np.concatenate(rows) if rows else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, type=kind))


def small_batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: a bijection whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))
