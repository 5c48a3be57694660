"""Quality scores by nearest labelled documents in a latent-semantic space.

Terms are a text's words and their shapes, hashed, with how often words recur; the model is their weights, the leading
singular vectors of a bounded labelled sample, and that sample's unit vectors with labels. It is of fixed size, so it is
broadcast. Every document is projected, its cosine to every labelled vector computed in blocks, and its nearest
neighbours vote with their similarity.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import columns, list_column, small_batches, texts

TERMS = 8_192  # hashed terms
DIMENSIONS = 64
SAMPLE = 2_000  # labelled documents of each class, at most
NEIGHBOURS = 25
BATCH = 1_000  # documents whose terms and cosines are held at a time
BLOCK = 100  # documents projected, and whose neighbours are sought, at a time: some 0.2 MB of a worker for each
KEPT_WORDS = 50_000  # a worker remembers the terms of, while its task runs
FEATURES = "label int, terms array<int>, weights array<float>, print binary"

SHAPES = ((re.compile(r"[A-ZÀ-ÖØ-Þ]+"), "X"), (re.compile(r"[^\W\d_X]+"), "x"), (re.compile(r"\d+"), "0"), (re.compile(r"([^\w\s])\1+"), r"\1+"))


def _hashed(term: str) -> int:
    return crc32(term.encode("utf-8", "surrogatepass")) % TERMS


def _shape(word: str) -> str:
    """Runs of capitals, other letters, digits and equal marks as one sign each."""
    for pattern, sign in SHAPES:
        word = pattern.sub(sign, word)
    return word[:12]


#: The shape hashes of ASCII letters alone or before one mark, by their capitals and that mark.
MARKS = frozenset(".,;:!?")
PLAIN = {(capital, mark): _hashed("s" + "X" * capital + "x" + mark) for capital in (False, True) for mark in ("", *MARKS)}


@lru_cache(maxsize=KEPT_WORDS)
def _word_terms(word: str) -> tuple[int, int]:
    """The terms of a word: itself without case or marks at its ends, and the shape of its letters, digits and marks."""
    own = _hashed("w" + word.lower().strip(".,;:!?\"'()"))
    letters, mark = (word[:-1], word[-1]) if word[-1:] in MARKS else (word, "")
    if letters.isascii() and letters.isalpha() and (letters[1:].islower() or len(letters) == 1 and letters.islower()):
        return own, PLAIN[letters[0].isupper(), mark]
    return own, _hashed("s" + _shape(word))


def term_weights(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of a text and 1 + log of their counts."""
    words = text.split()
    counts: dict[int, int] = {}
    distinct = Counter(words)
    for word, n in distinct.items():
        own, shape = _word_terms(word)
        counts[own] = counts.get(own, 0) + n
        counts[shape] = counts.get(shape, 0) + n
    repeats = sum(map(eq, words, words[1:]))
    size = max(len(words), 1)
    recurs = (f"words {len(words).bit_length()}", 1), (f"distinct {10 * len(distinct) // size} {size.bit_length()}", size // 4 + 1), (f"repeats {10 * repeats // size}", size // 4 + 1)
    for name, n in recurs:
        term = _hashed(name)
        counts[term] = counts.get(term, 0) + n
    found = np.fromiter(counts.keys(), dtype=np.int32, count=len(counts))
    return found, (1 + np.log(np.fromiter(counts.values(), dtype=np.float32, count=len(counts)))).astype(np.float32)


@dataclass
class Model:
    weights: np.ndarray  # of terms: how rare they are among labelled documents
    axes: np.ndarray  # (terms, dimensions)
    vectors: np.ndarray  # (labelled, dimensions), unit length
    labels: np.ndarray

    def project(self, terms: list[np.ndarray], values: list[np.ndarray]) -> np.ndarray:
        """Unit vectors of documents."""
        parts = [slice(start, start + BLOCK) for start in range(0, len(terms), BLOCK)]
        return np.concatenate([self._projected(terms[part], values[part]) for part in parts])

    def _projected(self, terms: list[np.ndarray], values: list[np.ndarray]) -> np.ndarray:
        flat = np.concatenate(terms)
        scaled = np.concatenate(values) * self.weights[flat]
        starts = np.cumsum([0, *map(len, terms)])[:-1]
        length = np.sqrt(np.add.reduceat(np.square(scaled), starts))
        rows = np.add.reduceat(scaled[:, None] * self.axes[flat], starts, axis=0) / np.maximum(length, 1e-9)[:, None]
        return unit(rows)

    def score(self, vectors: np.ndarray) -> np.ndarray:
        """The part of label 1 among the nearest labelled vectors, each weighted by its cosine."""
        cosine = vectors @ self.vectors.T  # in one product: its rounding depends on the number of rows
        return np.concatenate([self._voted(cosine[start : start + BLOCK]) for start in range(0, len(cosine), BLOCK)])

    def _voted(self, cosine: np.ndarray) -> np.ndarray:
        k = min(NEIGHBOURS, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-6).astype(np.float64) ** 4
        return (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)


def unit(rows: np.ndarray) -> np.ndarray:
    return (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        terms, weights = zip(*map(term_weights, columns(batch, "text")[0]), strict=True)
        prints = [blake2b(np.asarray(t).tobytes() + np.asarray(w).tobytes(), digest_size=8).digest() for t, w in zip(terms, weights, strict=True)]
        arrays = [batch.column("label"), list_column(terms, pa.int32()), list_column(weights, pa.float32()), pa.array(prints, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["label", "terms", "weights", "print"])


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, seed: int = 0) -> Model | None:
    """Learn from at most `sample` documents of each class 0 and 1, those first in the order of a hash of their ids.

    Null labels and ids teach nothing; a doc_id with two labels teaches both. None if no document is labelled.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).distinct()
    order = F.xxhash64(F.lit(seed), "doc_id")
    ids = documents.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    known = known.join(ids, "doc_id", "left_semi")
    chosen = [known.where(F.col("label") == c).orderBy(order, "doc_id").limit(sample) for c in (0, 1)]
    learned = texts(documents).join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    # As Arrow arrays: the sample's terms as Python objects would take as much of the driver again as all that follows.
    rows = learned.select("label", "text").mapInArrow(_features, FEATURES).toArrow().combine_chunks()
    many = rows.num_rows
    if not many:
        return None
    known_labels, prints = rows.column("label").to_numpy(), rows.column("print").to_pylist()
    order = sorted(range(many), key=lambda i: (known_labels[i], prints[i]))
    dense = np.zeros((many, TERMS), dtype=np.float32)
    terms, values = rows.column("terms"), rows.column("weights")
    for i, at in enumerate(order):
        dense[i, terms[at].values.to_numpy()] = values[at].values.to_numpy()
    known_labels = known_labels[order].astype(np.float64)
    del rows, terms, values
    weights = np.log((1 + many) / (1 + np.count_nonzero(dense, axis=0))).astype(np.float32) + 1
    dense *= weights  # in place: this is the largest array of the driver
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-9)
    draw = np.random.default_rng(seed).standard_normal((TERMS, DIMENSIONS + 16)).astype(np.float32)
    basis = np.linalg.qr(dense @ draw)[0]
    for _ in range(4):  # power iterations sharpen the leading directions
        basis = np.linalg.qr(dense @ (dense.T @ basis))[0]
    axes = np.linalg.svd(basis.T @ dense, full_matrices=False)[2][:DIMENSIONS].T.copy()
    return Model(weights, axes, unit(dense @ axes), known_labels)


def score(documents: DataFrame, model: Model | None, *keep: str | Column) -> DataFrame:
    """(`keep` columns, score): between 0 and 1, higher when label 1 is likelier.

    Null and empty texts are scored as texts without words. Repeated rows get equal scores. Without a model every score
    is 0.5. An empty table gives no rows.
    """
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for rows in small_batches(batches, BATCH):
            if own is None:
                scores = np.full(rows.num_rows, 0.5)
            else:
                scores = own.score(own.project(*zip(*map(term_weights, columns(rows, "text")[0]), strict=True)))
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(scores, pa.float64())], [*rows.schema.names[:-1], "score"])

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = documents.select(*keep, text)
    return rows.mapInArrow(rate, T.StructType([*rows.schema.fields[:-1], T.StructField("score", T.DoubleType())]))
