"""Scores of texts under a hierarchical Pitman-Yor language model.

Every training word that precedes another has a restaurant, and so has the begin of a text. The restaurants share one parent,
whose base is uniform over the vocabulary and one unknown word. Each Gibbs sweep takes all customers of a (context, word) out
and seats them anew, one after another, given the table totals of the sweep before; a word's tables are its customers in the
parent. Given those totals words are independent, so a sweep is a map over word counts whose only result is one total for each
restaurant, and random numbers hash from word, context and customer, so any task draws the same again. A pair met once always
has one table, so only pairs met again are seated. The last sweeps' predictive probabilities are averaged.

The most frequent words' restaurants have numbers and their totals go to every task. All others are told apart by 63 bits of
a hash, and dealt into shards by it. A part of the model sends each shard its contexts, in order, with what it has of them,
and gets back the totals alone, in that order.

Documents are written once, in blocks of numbered words. Tables hold a row for each block, part or shard, or for two of these
that meet, with lists for their words, contexts and documents: there are few rows to shuffle and sort. To score, a block sends
each distinct pair once, with the documents it occurs in, to the part that has the word, and only sums for each document come
back; the parts take turns, so that only a share of all this lies on disk at a time. A word too frequent for one part has its
row in several, and blocks choose among them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from basketry.llm.common import Words, columns, counted, discard, mixed, small_batches, texts, white, written

CONTEXTS = 256  # numbered restaurants: 0 is none, 1 at the begin of a text, the others after a frequent word
PART = 1_000_000  # training tokens of a part, about
DOCUMENTS = 8_192  # of a block, at most
BLOCK_BYTES = 24 << 20  # of a block's texts, about: a longer text is a block of its own
TOGETHER = 256  # texts split into words at a time
TURNS = 3  # in which the parts meet what is to be scored
DISCOUNT, STRENGTH = 0.8, 5.0
PARENT_DISCOUNT, PARENT_STRENGTH = 0.6, 50.0
BURN_IN, SAMPLES = 2, 2  # sweeps; those averaged
ONE_BY_ONE = 64  # customers seated singly; later ones come in parties of an eighth of those seated
HELD_ENTRIES = 2_000_000
END = b""  # no word is empty
RESTAURANTS, NAMED = -2, -1  # in place of a part: a shard's own restaurants, and its sums for those with numbers and the rest
# Lists that only this module's functions read are one value a row, words as lines and numbers side by side, little-endian, of
# the kinds in VALUES: Spark passes these on as they are, where it would copy the entries of an array one by one.
POSTINGS = "block long, doc_ids array<long>, held array<boolean>, lengths array<int>, words binary, n binary, token binary, tokens long"
COUNTS = "part long, words binary, each binary, context binary, n binary"
REPEATED = "part long, words binary, singles binary, each binary, context binary, n binary"
MET = "shard long, part long, context binary, visits binary, types binary, singles binary, again binary"
FOUND = "shard long, part long, context binary, visits binary, types binary, singles binary, tables binary"
TABLES = "shard long, part long, context binary, tables binary"
WANTED = "shard long, part long, context binary"
MODEL = "part long, words binary, total binary, each binary, context binary, probability binary, parent binary, others binary, rare binary, own binary"
BACKING = "shard long, context binary, scale binary, back binary"
MEETS = "part long, context binary, own binary, parent binary"
ASKED = "block long, part long, words binary, each binary, context binary, n binary, document binary"
ROWS = "word binary, total long, context array<long>, probability array<float>, parent array<double>, rare array<long>, own array<float>"
PACKED = "part long, context array<long>, own array<float>, parent array<double>"
SUMS = "block long, document array<short>, n_tokens array<int>, n_known array<int>, base_score array<double>, score array<double>"
VALUES = {"each": "<i4", "others": "<i4", "n": "<i4", "token": "<i4", "document": "<i2", "again": "?", "probability": "<f4", "own": "<f4"}
VALUES |= dict.fromkeys(("tables", "scale", "back", "parent"), "<f8") | dict.fromkeys(("context", "rare", "visits", "types", "singles", "total"), "<i8")
MEASURES = ("n_tokens", "n_known", "base_score", "score")
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def is_held_out(doc_id: int | None, parts: int = 7, part: int = 2) -> bool:
    return doc_id is not None and crc32(str(doc_id).encode()) % parts == part


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column's rows and the number in each row."""
    return column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)


def _listed(values: np.ndarray, lengths: np.ndarray, name: str) -> pa.Array:
    """A value for each row with so many of the numbers of column `name`."""
    values = np.ascontiguousarray(values, dtype=VALUES[name])
    ends = np.concatenate([[0], np.cumsum(lengths)]) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(values)]).cast(pa.binary())


def _lists(table: pa.Table | pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows of column `name`, and how many are in each."""
    column, kind = _column(table, name), np.dtype(VALUES[name])
    if not len(column):
        return np.zeros(0, dtype=kind), np.zeros(0, dtype=np.int64)
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) // kind.itemsize
    start = np.frombuffer(column.buffers()[1], np.int32, 1, column.offset * 4)[0]
    data = column.buffers()[2]
    return (np.frombuffer(data, kind, lengths.sum(), start) if data is not None else np.zeros(0, dtype=kind)), lengths


def _numbers(table: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    return _lists(table, name)[0]


def _column(table: pa.Table | pa.RecordBatch, name: str) -> pa.Array:
    column = table.column(name)
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _names(table: pa.Table | pa.RecordBatch) -> list[bytes]:
    """The words of all rows."""
    return [word for lines in _column(table, "words").to_pylist() for word in lines.split(b"\n")]


def _lines(words: list[bytes], lengths: np.ndarray) -> pa.Array:
    """A value for each row with so many words; no row is without."""
    ends = np.cumsum([0, *lengths]).tolist()
    return pa.array([b"\n".join(words[a:b]) for a, b in zip(ends, ends[1:], strict=False)], pa.binary())


def _grouped(values: np.ndarray | pa.Array, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values if isinstance(values, pa.Array) else pa.array(values, kind))


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The sum of each run of `lengths` whole numbers."""
    ends = np.concatenate([[0], np.cumsum(values)])
    at = np.concatenate([[0], np.cumsum(lengths)])
    return ends[at[1:]] - ends[at[:-1]]


def _runs(*sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal keys begins, and how long it is."""
    new = np.ones(len(sorted_keys[0]), dtype=bool)
    new[1:] = reduce(np.logical_or, (k[1:] != k[:-1] for k in sorted_keys))
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(new)))


def context_hash(word: bytes) -> int:
    """The restaurant of a word without a number; never one of the numbers, as it is negative."""
    return (xxh3_64_intdigest(word) >> 1) - 2**63


def _hashes(words: list[bytes]) -> np.ndarray:
    """`context_hash` of many words."""
    return (np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words)) >> np.uint64(1)).astype(np.int64) + np.iinfo(np.int64).min


def _numbered(documents: DataFrame) -> DataFrame:
    """A row for each block: its documents, the lengths of their texts in tokens, its distinct words by how often they occur,
    how often each does in training texts, and the number of the word at each token."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in small_batches(batches, DOCUMENTS):
            size = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
            first, each = _runs(size // BLOCK_BYTES)
            for start, length in zip(first, each, strict=True):
                ids, all_texts = columns(batch.slice(start, length), "doc_id", "text")
                held = np.array([is_held_out(doc_id) for doc_id in ids])
                sizes, letters, lengths = [], [], []
                for at in range(0, len(ids), TOGETHER):
                    words = Words(all_texts[at : at + TOGETHER], lower=True)
                    sizes.append(np.insert(words.last - words.first, words.ends, 0))  # each text has its end
                    letters.append(words.data[~white(words.data)])
                    lengths.append(words.ends - words.begins + 1)
                lengths, letters = np.concatenate(lengths), np.concatenate(letters)
                ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
                tokens = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(letters)]).dictionary_encode()
                flat = tokens.indices.to_numpy()
                order = np.argsort(-np.bincount(flat), kind="stable")
                place = np.empty(len(order), dtype=np.int32)
                place[order] = np.arange(len(order))
                flat = place[flat]
                n = np.bincount(flat[~np.repeat(held, lengths)], minlength=len(order))
                lists = {
                    "doc_ids": _grouped(pa.array(ids, pa.int64()), [len(ids)], pa.int64()),
                    "held": _grouped(held, [len(ids)], pa.bool_()),
                    "lengths": _grouped(np.array(lengths), [len(ids)], pa.int32()),
                    "words": pa.array([b"\n".join(tokens.dictionary.take(pa.array(order)).to_numpy(zero_copy_only=False).tolist())], pa.binary()),
                    "n": _listed(n, [len(n)], "n"),
                    "token": _listed(flat, [len(flat)], "token"),
                }
                yield pa.RecordBatch.from_pydict({"block": pa.array([block]), **lists, "tokens": pa.array([int(n.sum())])})
                block += 1

    return texts(documents).mapInArrow(number, POSTINGS)


def _named(numbered: DataFrame, frequent: list[bytes]) -> DataFrame:
    """Blocks with the words whose restaurants have numbers."""
    return numbered.withColumn("frequent", F.array(*map(F.lit, frequent)).cast("array<binary>"))


def postings(documents: DataFrame, frequent: list[bytes]) -> DataFrame:
    """The blocks of all documents, and which words' restaurants have numbers."""
    return _named(_numbered(documents), frequent)


def _most_frequent(numbered: DataFrame, parts: int, most: int) -> list[tuple[bytes, int]]:
    """The most frequent training words and how often they occur, equal ones by their bytes."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in _single(batch):
                names, n = _names(one), _numbers(one, "n")
                part = np.where(n > 0, _hashes(names) % parts, parts)
                order = np.argsort(part, kind="stable")[: int((n > 0).sum())]
                first, each = _runs(part[order])
                lists = [_lines([names[i] for i in order.tolist()], each), _listed(n[order], each, "n")]
                yield pa.RecordBatch.from_arrays([pa.array(part[order][first]), *lists], ["part", "words", "n"])

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, total = pa.array([], pa.binary()), np.zeros(0)
        for batch in batches:
            every = pa.concat_arrays([names, pa.array(_names(batch), pa.binary())]).dictionary_encode()
            names, total = every.dictionary, np.bincount(every.indices.to_numpy(), weights=np.concatenate([total, _numbers(batch, "n")]))
        least = np.partition(total, -most)[-most] if len(total) > most else 0
        at = np.flatnonzero(total >= least)
        best = sorted(zip((-total[at]).astype(int).tolist(), names.take(pa.array(at)).to_pylist(), strict=True))[:most]
        yield pa.RecordBatch.from_arrays([pa.array([w for _, w in best], pa.binary()), pa.array([-n for n, _ in best], pa.int64())], ["word", "n"])

    dealt = numbered.select("words", "n").mapInArrow(deal, "part long, words binary, n binary")
    found = counted(dealt.repartitionById(parts, F.col("part").cast("int")).mapInArrow(top, "word binary, n long"), "frequent", clean=True)[0]
    best = [(bytes(r["word"]), r["n"]) for r in found.orderBy(F.desc("n"), "word").limit(most).collect()]
    discard(found)
    return best


def _single(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, 1) for at in range(batch.num_rows))


class Block:
    """A row of postings."""

    def __init__(self, row: pa.RecordBatch):
        self.number = row.column("block")[0].as_py()
        self.words = _names(row)
        self.hashes = _hashes(self.words)
        self.contexts = np.append(self.hashes, 1)
        numbers = {word: i + 2 for i, word in enumerate(row.column("frequent")[0].as_py())}
        for place, word in enumerate(self.words):
            if word in numbers:
                self.contexts[place] = numbers[word]
        lengths = row.column("lengths")[0].values.to_numpy()
        self.token = _numbers(row, "token").astype(np.int64)
        self.before = np.concatenate([[0], self.token[:-1]])
        self.before[np.cumsum(lengths) - lengths] = len(self.words)
        self.document = np.repeat(np.arange(len(lengths)), lengths)
        self.held = np.repeat(row.column("held")[0].values.to_numpy(zero_copy_only=False), lengths)

    def dealt(self, part: np.ndarray, wanted: np.ndarray, occurrences: bool = False) -> pa.RecordBatch | None:
        """COUNTS of the wanted tokens' pairs, or ASKED with the document of each occurrence, where `part` is that of each word."""
        by_part = np.argsort(part, kind="stable")
        rank = np.empty(len(part), dtype=np.int64)
        rank[by_part] = np.arange(len(part))
        key = rank[self.token[wanted]] * len(self.contexts) + self.before[wanted]
        if not len(key):
            return None
        if occurrences:
            order = np.argsort(key, kind="stable")
            document, key = self.document[wanted][order], key[order]
        else:
            key.sort()
        first, n = _runs(key)
        ranks, before = np.divmod(key[first], len(self.contexts))
        start, each = _runs(ranks)
        used = by_part[ranks[start]]
        begin, words = _runs(part[used])
        pairs = _sums(each, words)
        rows = {
            "part": pa.array(part[used][begin], pa.int64()),
            "words": _lines([self.words[i] for i in used.tolist()], words),
            "each": _listed(each, words, "each"),
            "context": _listed(self.contexts[before], pairs, "context"),
            "n": _listed(n, pairs, "n"),
        }
        if occurrences:
            rows = {"block": pa.array(np.full(len(begin), self.number)), **rows, "document": _listed(document, _sums(n, pairs), "document")}
        return pa.RecordBatch.from_pydict(rows)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        yield from map(Block, _single(batch))


def _by_context(words: np.ndarray, context: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums for each (word number, context), in order."""
    order = np.lexsort((context, words))
    words, context, n = words[order], context[order], n[order]
    first, _ = _runs(words, context)
    return words[first], context[first], np.add.reduceat(n, first) if len(first) else n


def context_counts(posted: DataFrame, parts: int) -> DataFrame:
    """COUNTS: each training word's count in every restaurant it visits, in rows of many words of a part."""

    def in_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            if (found := block.dealt(block.hashes % parts, ~block.held)) is not None:
                yield found

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, part, held = pa.array([], pa.binary()), np.zeros(0, dtype=np.int64), [np.zeros(0, dtype=np.int64)] * 3
        waiting: list[tuple] = []

        def merged() -> tuple[pa.Array, np.ndarray, list[np.ndarray]]:
            every = pa.concat_arrays([names, *(w for w, _, _ in waiting)]).dictionary_encode()
            place = every.indices.to_numpy().astype(np.int64)
            parts_of = np.empty(len(every.dictionary), dtype=np.int64)
            parts_of[place] = np.concatenate([part, *(p for _, p, _ in waiting)])
            starts = np.cumsum([0, len(names), *(len(w) for w, _, _ in waiting)])
            pairs = [(place[start + rows[0]], *rows[1:]) for start, rows in zip(starts, [held, *(rows for _, _, rows in waiting)], strict=False)]
            return every.dictionary, parts_of, list(_by_context(*map(np.concatenate, zip(*pairs, strict=True))))

        for batch in batches:
            words, (each, lengths) = pa.array(_names(batch), pa.binary()), _lists(batch, "each")
            rows = np.repeat(np.arange(len(words)), each), _numbers(batch, "context"), _numbers(batch, "n").astype(np.int64)
            waiting.append((words, np.repeat(batch.column("part").to_numpy(), lengths), rows))
            if sum(len(rows[0]) for _, _, rows in waiting) > max(HELD_ENTRIES, len(held[0])):
                (names, part, held), waiting = merged(), []
        names, part, (words, context, n) = merged()
        each = np.bincount(words, minlength=len(names))
        ends = np.cumsum([0, *each])
        for own in np.unique(part):
            of_part = np.flatnonzero(part == own)
            first, _ = _runs(np.cumsum(each[of_part]) // HELD_ENTRIES)
            for some in np.split(of_part, first[1:]):
                total = each[some].sum()
                at = np.repeat(ends[some] - np.cumsum(each[some]) + each[some], each[some]) + np.arange(total)
                lists = [_lines(names.take(pa.array(some)).to_numpy(zero_copy_only=False).tolist(), [len(some)]), _listed(each[some], [len(some)], "each")]
                lists += [_listed(context[at], [total], "context"), _listed(n[at], [total], "n")]
                yield pa.RecordBatch.from_arrays([pa.array([own]), *lists], ["part", "words", "each", "context", "n"])

    blocks = posted.select("block", "held", "lengths", "words", "token", "frequent").mapInArrow(in_block, COUNTS)
    return blocks.repartitionById(parts, F.col("part").cast("int")).mapInArrow(merge, COUNTS)


@dataclass
class Totals:
    """What a sweep leaves, the totals of restaurants without a number aside."""

    tables: np.ndarray  # (CONTEXTS,)
    parent_tables: float
    parent_customers: float


def _chance(seed: np.ndarray, step: int) -> np.ndarray:
    """Numbers in [0, 1) that hash from `seed` and `step`."""
    return (mixed(seed + np.uint64(step * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(11)).astype(np.float64) / 2.0**53


def seat(n: np.ndarray, new: np.ndarray, discount: float, seed: np.ndarray) -> np.ndarray:
    """Tables after seating `n` customers each: a customer opens one with weight `new`, or joins one of the seated."""
    order = np.argsort(-n, kind="stable")
    left, new, seed = n[order], new[order], seed[order]
    tables = np.minimum(left, 1).astype(np.float64)
    seated, rows = 1, int(np.searchsorted(-left, -1, side="left"))
    while rows:
        party = 1 if seated < ONE_BY_ONE else seated // 8
        coming = np.minimum(party, left[:rows] - seated)
        opens = coming * new[:rows] / (new[:rows] + seated - discount * tables[:rows])
        tables[:rows] += np.floor(opens + _chance(seed[:rows], seated))
        seated += party
        rows = int(np.searchsorted(-left, -seated, side="left"))
    found = np.empty(len(n))
    found[order] = np.minimum(tables, left)
    return found


class Sweep:
    """The seating of some words in sweep number `number`, given the totals of the sweep before."""

    def __init__(
        self,
        words: list[bytes],
        singles: np.ndarray,
        row: np.ndarray,
        context: np.ndarray,
        n: np.ndarray,
        met: np.ndarray,
        before: Totals,
        vocabulary: int,
        number: int,
    ):
        """`row`, `context`, `n` are pairs met again, `met` the tables of their restaurants before; `singles` counts a word's others."""
        seed = np.array([xxh3_64_intdigest(w, seed=number) for w in words], dtype=np.uint64)
        seeds = mixed(seed[row] + context.astype(np.uint64))
        opening = STRENGTH + DISCOUNT * met
        self.base = 1 / (vocabulary + 1)
        self.customers = singles + np.bincount(row, minlength=len(words)).astype(np.float64)  # one table each to begin with
        for again in range(2):
            self.parent_tables = seat(self.customers.astype(np.int64), np.full(len(words), self._parent_opening(before) * self.base), PARENT_DISCOUNT, seed + np.uint64(again))
            self.tables = seat(n, opening * self.parent(before)[row], DISCOUNT, seeds + np.uint64(again))
            self.customers = singles + np.bincount(row, weights=self.tables, minlength=len(words))
        self.parent_tables = np.minimum(self.parent_tables, self.customers)

    @staticmethod
    def _parent_opening(totals: Totals) -> float:
        return PARENT_STRENGTH + PARENT_DISCOUNT * totals.parent_tables

    def parent(self, totals: Totals) -> np.ndarray:
        """The parent's probability of each word."""
        own = self.customers - PARENT_DISCOUNT * self.parent_tables
        return (own + self._parent_opening(totals) * self.base) / (PARENT_STRENGTH + totals.parent_customers)


def _rows(table: pa.Table | pa.RecordBatch) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """The words of COUNTS, and for each pair the word's place, the context and the count."""
    each = _numbers(table, "each")
    return _names(table), np.repeat(np.arange(len(each)), each), _numbers(table, "context"), _numbers(table, "n").astype(np.int64)


def _met(context: np.ndarray, named: np.ndarray, shards: int, sent: pa.Table) -> np.ndarray:
    """The tables of each context: of its number, or as the shards sent them for a part's contexts in order."""
    found = named[np.maximum(context, 0)].astype(np.float64)
    rare = context < 0
    own, place = np.unique(context[rare], return_inverse=True)
    tables = np.empty(len(own))
    sent = sent.take(pa.array(np.argsort(_column(sent, "shard").to_numpy())))
    tables[np.argsort(own % shards, kind="stable")] = _numbers(sent, "tables")
    found[rare] = tables[place]
    return found


def _to_shards(part: int, shards: int, context: np.ndarray, **values: np.ndarray) -> pa.RecordBatch:
    """A row for each shard with those of a part's contexts, in order, that are there, and their values."""
    shard = context % shards
    order = np.argsort(shard, kind="stable")
    first, each = _runs(shard[order])
    lists = {name: _listed(v[order], each, name) for name, v in {"context": context, **values}.items()}
    return pa.RecordBatch.from_pydict({"shard": pa.array(shard[order][first], pa.int64()), "part": pa.array(np.full(len(first), part)), **lists})


def _with_rest(context: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums for each number of a restaurant, and last for all that have none."""
    return np.bincount(np.where(context < 0, CONTEXTS, context), weights=values, minlength=CONTEXTS + 1)


def _restaurants(counts: DataFrame, shards: int) -> DataFrame:
    """FOUND: of each shard a row with its restaurants without a number, one with sums for those with numbers, and what it
    sends each part: the tables to begin with of the contexts of its pairs met again."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in _single(batch):
                n = _numbers(one, "n")
                own, place = np.unique(_numbers(one, "context"), return_inverse=True)
                sums = [np.bincount(place, weights=w, minlength=len(own)) for w in (n, np.ones(len(n)), n == 1)]
                yield _to_shards(one.column("part")[0].as_py(), shards, own, **dict(zip(("visits", "types", "singles"), sums, strict=True)), again=sums[1] > sums[2])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        context, lengths = _lists(table, "context")
        own, place = np.unique(context, return_inverse=True)
        sums = {m: np.bincount(place, weights=_numbers(table, m), minlength=len(own)) for m in ("visits", "types", "singles")}
        again = _numbers(table, "again") & (context < 0)
        part, back, _ = _by_context(np.repeat(_column(table, "part").to_numpy(), lengths)[again], place[again], np.zeros(int(again.sum())))
        first, each = _runs(part)
        rare, none = own < 0, np.zeros(len(first), dtype=np.int64)
        lists = {m: _listed(np.concatenate([s[rare], _with_rest(own, s)]), [rare.sum(), CONTEXTS + 1, *none], m) for m, s in sums.items()}
        return pa.table(
            {
                "shard": pa.array(np.full(len(first) + 2, key[0].as_py())),
                "part": pa.array([RESTAURANTS, NAMED, *part[first]], pa.int64()),
                "context": _listed(own[rare], [rare.sum(), 0, *none], "context"),
                **lists,
                "tables": _listed(sums["types"][back], [0, 0, *each], "tables"),
            }
        )

    sent = counts.select("part", "context", "n").mapInArrow(send, MET)
    return written(sent.groupBy("shard").applyInArrow(add, FOUND), "restaurants", clean=True, codec="zstd")


def _sweep(
    repeated: DataFrame, sent: DataFrame, restaurants: DataFrame, shards: int, before: Totals, vocabulary: int, number: int, singles: np.ndarray, all_singles: int
) -> tuple[Totals, DataFrame]:
    """The totals of a sweep, and as TABLES those of each shard's restaurants, and what it sends each part."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        words, row, context, n = _rows(left)
        done = Sweep(words, _numbers(left, "singles"), row, context, n, _met(context, before.tables, shards, right), before, vocabulary, number)
        own, place = np.unique(context, return_inverse=True)
        tables = np.bincount(place, weights=done.tables, minlength=len(own))
        own, tables = np.append(own, 0), np.append(tables, done.parent_tables.sum())
        return pa.Table.from_batches([_to_shards(left.column("part")[0].as_py(), shards, own, tables=tables)])

    def add(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        own, own_singles = (_numbers(right, c) for c in ("context", "singles"))
        context, lengths = _lists(left, "context")
        tables, rare = _numbers(left, "tables"), context < 0
        place = np.searchsorted(own, context[rare])
        found = np.bincount(place, weights=tables[rare], minlength=len(own))
        each = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[rare], minlength=len(lengths))
        values = np.concatenate([found, _with_rest(context, tables), (own_singles + found)[place]])
        return pa.table(
            {
                "shard": pa.array(np.full(len(each) + 2, key[0].as_py())),
                "part": pa.array([RESTAURANTS, NAMED, *_column(left, "part").to_numpy()], pa.int64()),
                "context": _listed(own[:0], np.zeros(len(each) + 2, dtype=np.int64), "context"),
                "tables": _listed(values, [len(found), CONTEXTS + 1, *each], "tables"),
            }
        )

    seated = repeated.groupBy("part").cogroup(sent.groupBy("part")).applyInArrow(run, TABLES)
    own = restaurants.where(F.col("part") == RESTAURANTS).select("shard", "context", "singles")
    sums = written(seated.groupBy("shard").cogroup(own.groupBy("shard")).applyInArrow(add, TABLES), "tables", clean=True)
    named = sum((np.frombuffer(r["tables"], VALUES["tables"]) for r in sums.where(F.col("part") == NAMED).select("tables").collect()), np.zeros(CONTEXTS + 1))
    return Totals(singles + np.array([0.0, *named[1:CONTEXTS]]), named[0], all_singles + named[1:].sum()), sums


@dataclass
class Model:
    parts: DataFrame  # MODEL: a training word's probability in the numbered contexts it was seen in, and by the parent of each
    # sample; in each other context, its customers less what their tables discount
    backing: DataFrame  # BACKING of restaurants without a number: what one customer weighs, and `opening` in each sample
    shards: int
    tokens: int
    vocabulary: int
    opening: np.ndarray  # (SAMPLES, CONTEXTS): what a word not seen in a context gets of its parent's probability
    unknown: np.ndarray  # (SAMPLES,): the parent's probability of a word never seen

    @property
    def rows(self) -> DataFrame:
        """A row for each word."""

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                total = _numbers(batch, "total")
                lists = {c: pa.array(_numbers(batch, c)) for c in ("context", "probability", "parent", "rare", "own")}
                lengths = {c: _numbers(batch, n) for n, some in (("each", ("context", "probability")), ("others", ("rare", "own"))) for c in some}
                lengths["parent"] = np.full(len(total), SAMPLES)
                grouped = {c: _grouped(v, lengths[c], v.type) for c, v in lists.items()}
                yield pa.RecordBatch.from_pydict({"word": pa.array(_names(batch), pa.binary()), "total": pa.array(total), **grouped})

        return self.parts.mapInArrow(each, ROWS)

    @property
    def restaurants(self) -> DataFrame:
        """(context, scale, back): a row for each restaurant without a number."""

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                context, scale, back = (_numbers(batch, c) for c in ("context", "scale", "back"))
                yield pa.RecordBatch.from_arrays([pa.array(context), pa.array(scale), _grouped(back, np.full(len(context), SAMPLES), pa.float64())], ["context", "scale", "back"])

        return self.backing.mapInArrow(each, "context long, scale double, back array<double>")


def fit(posted: DataFrame, parts: int = 8) -> Model:
    """Sample the seating of all training words, in `parts` parts."""
    shards = max(8, parts // 2)
    counts = written(context_counts(posted, parts), "word-counts", clean=True, codec="zstd")

    def met_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in _single(batch):
                each, context, n = (_numbers(one, c) for c in ("each", "context", "n"))
                more = n > 1
                left = _sums(more, each)
                lists = {"singles": each - left, "each": left, "context": context[more], "n": n[more]}
                lists = {"words": one.column("words"), **{c: _listed(v, [len(v)], c) for c, v in lists.items()}}
                yield pa.RecordBatch.from_pydict({"part": one.column("part"), **lists})

    restaurants = _restaurants(counts, shards)
    named = np.zeros((3, CONTEXTS + 1))
    for r in restaurants.where(F.col("part") == NAMED).select("visits", "types", "singles").collect():
        named += np.array([np.frombuffer(r[m], VALUES[m]) for m in ("visits", "types", "singles")])
    tokens, all_types, all_singles = (int(x) for x in named.sum(axis=1))
    visits, types, singles = named[:, :CONTEXTS]
    repeated = written(counts.mapInArrow(met_again, REPEATED), "met-again", codec="zstd")
    vocabulary = counts.agg(F.sum(F.octet_length("each"))).first()[0] or 0
    vocabulary //= np.dtype(VALUES["each"]).itemsize
    to_parts = F.col("part") >= 0
    totals, sums, sent = [Totals(types, float(vocabulary), float(all_types))], [], [restaurants.where(to_parts).select("shard", "part", "tables")]
    for number in range(BURN_IN + SAMPLES):
        after, found = _sweep(repeated, sent[-1], restaurants, shards, totals[-1], vocabulary, number, singles, all_singles)
        totals.append(after)
        sums.append(found)
        sent.append(found.where(to_parts).select("shard", "part", "tables"))
    shared = counts.sparkSession.sparkContext.broadcast((totals, visits))

    def predict(left: pa.Table, right: pa.Table) -> pa.Table:
        all_totals, visits = shared.value
        words, row, context, n = _rows(left)
        more, numbered, singles = n > 1, context >= 0, np.bincount(row[n == 1], minlength=len(words))
        own, parents, chance = np.zeros(len(n)), [], np.zeros(int(numbered.sum()))
        for i, number in enumerate(range(BURN_IN, BURN_IN + SAMPLES)):
            before, after = all_totals[number], all_totals[number + 1]
            met = _met(context[more], before.tables, shards, right.filter(pc.equal(right.column("sample"), i)))
            done = Sweep(words, singles, row[more], context[more], n[more], met, before, vocabulary, number)
            tables = np.ones(len(n))
            tables[more] = done.tables
            parents.append(done.parent(after))
            own += (n - DISCOUNT * tables) / SAMPLES
            at = context[numbered]
            opening = STRENGTH + DISCOUNT * after.tables[at]
            chance += ((n - DISCOUNT * tables)[numbered] + opening * parents[-1][row[numbered]]) / (STRENGTH + visits[at]) / SAMPLES
        each, others = (np.bincount(row[x], minlength=len(words)) for x in (numbered, ~numbered))
        total = np.bincount(row, weights=n, minlength=len(words)).astype(np.int64)
        lists = {
            "total": total,
            "each": each,
            "context": context[numbered],
            "probability": chance,
            "parent": np.array(parents).T.ravel(),
            "others": others,
            "rare": context[~numbered],
            "own": own[~numbered],
        }
        return pa.table({"part": _column(left, "part").slice(0, 1), "words": _lines(words, [len(words)]), **{c: _listed(v, [len(v)], c) for c, v in lists.items()}})

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            context, lengths = _lists(batch, "context")
            n, own = (_numbers(batch, c) for c in ("visits", "singles"))
            back = np.array([(STRENGTH + DISCOUNT * (own + np.frombuffer(b"".join(columns(batch, f"tables{i}")[0]), VALUES["tables"]))) / (STRENGTH + n) for i in range(SAMPLES)])
            lists = [batch.column("context"), _listed(1 / (STRENGTH + n), lengths, "scale"), _listed(back.T.ravel(), lengths * SAMPLES, "back")]
            yield pa.RecordBatch.from_arrays([batch.column("shard"), *lists], ["shard", "context", "scale", "back"])

    last = totals[BURN_IN + 1 :]
    opening = np.array([(STRENGTH + DISCOUNT * t.tables) / (STRENGTH + visits) for t in last])
    unknown = [(PARENT_STRENGTH + PARENT_DISCOUNT * t.parent_tables) / (vocabulary + 1) / (PARENT_STRENGTH + t.parent_customers) for t in last]
    befores = reduce(DataFrame.unionByName, (sent[BURN_IN + i].withColumn("sample", F.lit(i)) for i in range(SAMPLES)))
    rare = restaurants.where(F.col("part") == RESTAURANTS).select("shard", "context", "visits", "singles")
    for i in range(SAMPLES):
        rare = rare.join(sums[BURN_IN + i].where(F.col("part") == RESTAURANTS).select("shard", F.col("tables").alias(f"tables{i}")), "shard")
    rows = counts.groupBy("part").cogroup(befores.groupBy("part")).applyInArrow(predict, MODEL)
    backing = written(rare.mapInArrow(opened, BACKING), "backing", clean=True, codec="zstd")
    discard(restaurants, repeated, sums[0], *sums[BURN_IN + SAMPLES - 1 :])
    rows = written(rows, "model", clean=True, codec="zstd")
    # The model stands by itself from here: what it was made from need not lie beside the postings when those are dealt out.
    discard(counts, *sums[1 : BURN_IN + SAMPLES - 1])
    return Model(rows, backing, shards, tokens, vocabulary, opening, np.array(unknown))


def _asked_for(part: np.ndarray, context: np.ndarray, shards: int) -> pa.RecordBatch:
    """A row for each shard and part with the distinct contexts that the part wants of the shard."""
    group, context, _ = _by_context(part * shards + context % shards, context, np.zeros(len(part)))
    first, each = _runs(group)
    at, shard = np.divmod(group[first], shards)
    return pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(at, pa.int64()), _listed(context, each, "context")], ["shard", "part", "context"])


def _alike(part: np.ndarray, context: np.ndarray, scale: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """The restaurants of each part, alike ones beside each other: the parts, how many each has, and these."""
    order = np.lexsort((*back.T, scale, part))
    first, each = _runs(part[order])
    return part[order][first], each, {"context": context[order], "own": scale[order].astype(np.float32), "parent": back[order].ravel()}


def _packed(restaurants: DataFrame) -> DataFrame:
    """Restaurants in rows of their own, (part, context, scale, back), as rows of many, as a row for each is costly to shuffle and sort."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            part, each, lists = _alike(*map(np.concatenate, zip(*waiting, strict=True)))
            return pa.RecordBatch.from_pydict({"part": pa.array(part), **{c: _grouped(v, each * (len(v) // each.sum()), pa.from_numpy_dtype(v.dtype)) for c, v in lists.items()}})

        waiting = []
        for batch in batches:
            if not batch.num_rows:
                continue
            back = _flat(batch.column("back"))[0].reshape(batch.num_rows, -1)
            waiting.append((*(batch.column(c).to_numpy() for c in ("part", "context", "scale")), back))
            if sum(len(w[0]) for w in waiting) > HELD_ENTRIES // 4:
                yield rows()
                waiting = []
        if waiting:
            yield rows()

    return restaurants.select("part", "context", "scale", "back").mapInArrow(pack, PACKED)


def _wanted(rows: DataFrame, held: DataFrame, backing: DataFrame, shards: int) -> DataFrame:
    """MEETS: the restaurants that each part meets, in the model's `rows` of it and in the contexts of `held`."""

    def of_model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            context, lengths = _lists(batch, "rare")
            yield _asked_for(np.repeat(batch.column("part").to_numpy(), lengths), context, shards)

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        own, scale, back = (_numbers(right, c) for c in ("context", "scale", "back"))
        context, lengths = _lists(left, "context")
        part = np.repeat(_column(left, "part").to_numpy(), lengths)
        at, there = Lookup._at(own, context)
        part, context = part[there], context[there]
        part, context, _ = _by_context(part, context, np.zeros(len(part)))
        at = np.searchsorted(own, context)
        part, each, lists = _alike(part, context, scale[at], back.reshape(-1, SAMPLES)[at])
        return pa.table({"part": pa.array(part), **{c: _listed(v, each * (SAMPLES if c == "parent" else 1), c) for c, v in lists.items()}})

    asked = rows.select("part", "rare").mapInArrow(of_model, WANTED).unionByName(held)
    return asked.groupBy("shard").cogroup(backing.groupBy("shard")).applyInArrow(find, MEETS)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sum of the value rows of each key."""
    every, values = (np.concatenate(x) for x in zip(*parts, strict=True))
    own, place = np.unique(every, return_inverse=True)
    return own, np.stack([np.bincount(place, weights=v, minlength=len(own)) for v in values.T], axis=1)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the sums of each block's documents, whose ids come in a row of their own."""
    listed, waiting = {}, []
    for batch in batches:
        ids, held = columns(batch, "doc_ids", "held")
        listed |= {b: (i, h) for b, i, h in zip(columns(batch, "block")[0], ids, held, strict=True) if i is not None}
        document, lengths = _flat(batch.column("document"))
        if len(document):
            block = np.repeat(batch.column("block").to_numpy(), lengths)
            values = [_flat(batch.column(m))[0].astype(np.float64) for m in MEASURES]
            waiting.append((block * DOCUMENTS + document, np.stack(values, axis=1)))
        if sum(len(k) for k, _ in waiting) > HELD_ENTRIES // 4:
            waiting = [_added(waiting)]
    if not waiting:
        return
    keys, values = _added(waiting)
    for block, (ids, held) in sorted(listed.items()):
        at = slice(*np.searchsorted(keys, [block * DOCUMENTS, (block + 1) * DOCUMENTS]))
        counts = values[at, :2].astype(np.int64).T
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(held), *map(pa.array, counts), *map(pa.array, values[at, 2:].T.copy())],
            ["doc_id", "held_out", *MEASURES],
        )


class Lookup:
    """A part of the model: the restaurants and words that its postings meet."""

    def __init__(self, restaurants: list[pa.RecordBatch], rows: list[pa.RecordBatch], opening: np.ndarray, unknown: np.ndarray):
        samples = len(unknown)
        self.opening, self.words = opening, {}
        held = [(_numbers(b, "context"), _numbers(b, "own"), _numbers(b, "parent").reshape(-1, samples)) for b in restaurants]
        held.append((np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros((0, samples))))
        context, scale, back = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(context)
        self.restaurants, self.scale, self.back = context[order], scale[order], back[order]
        totals, parents, pairs = [np.zeros(1, dtype=np.int64)], [unknown[None]], [(np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0),)]
        for b in rows:
            start = len(self.words) + 1
            self.words |= {w: start + i for i, w in enumerate(_names(b))}
            totals.append(_numbers(b, "total"))
            parents.append(_numbers(b, "parent").reshape(-1, samples))
            for lengths, at, value in (("each", "context", "probability"), ("others", "rare", "own")):
                each = _numbers(b, lengths)
                pairs.append((np.repeat(np.arange(start, start + len(each)), each), _numbers(b, at), _numbers(b, value).astype(np.float64)))
        self.total, self.parent = np.concatenate(totals), np.concatenate(parents)
        word, context, value = (np.concatenate(x) for x in zip(*pairs, strict=True))
        self.contexts, place = np.unique(context, return_inverse=True)
        key = word * len(self.contexts) + place
        order = np.argsort(key)
        self.keys, self.values = key[order], value[order]

    @staticmethod
    def _at(sorted_values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each wanted value is, and whether it is there."""
        if not len(sorted_values):
            return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
        at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
        return at, sorted_values[at] == wanted

    def probability(self, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Averaged over the samples; a context without a restaurant leaves all to the parent."""
        rare = context < 0
        at, met = self._at(self.restaurants, context)
        back = self.opening[:, np.maximum(context, 0)].T
        back[rare] = 1.0
        back[met] = self.back[at[met]]
        found = (back * self.parent[word]).mean(axis=1)
        place, known = self._at(self.contexts, context)
        pair, seen = self._at(self.keys, word * len(self.contexts) + place)
        seen &= known
        found[seen & ~rare] = self.values[pair[seen & ~rare]]
        seen &= rare
        found[seen] += self.values[pair[seen]] * self.scale[at[seen]]
        return found


def score(documents: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Tokens are the words that ASCII white space separates with A-Z lowered, and one end for each text; a null or empty
    text is its end alone. Scores are base-10 logarithms of the probability of the whole text; the base is the unigram
    with one added to each count. Rows without an id are not held out. Repeated rows are documents of their own. An empty
    table gives no rows.
    """
    spark = documents.sparkSession
    seen = Observation()
    numbered = written(_numbered(documents).observe(seen, F.sum("tokens").alias("tokens")), "postings", codec="zstd")
    parts = max(8, -(-(seen.get["tokens"] or 0) // PART))
    top = _most_frequent(numbered, parts, CONTEXTS - 1)
    posted = _named(numbered, [word for word, _ in top if word != END][: CONTEXTS - 2])
    model = fit(posted, parts)
    copies = {word: -(-n // PART) for word, n in top if n > PART}
    shared = spark.sparkContext.broadcast((model.tokens, model.vocabulary, model.opening, model.unknown))
    shards = model.shards

    def part_of(block: Block) -> np.ndarray:
        """The part that each of a block's words is looked up in."""
        found = block.hashes % parts
        for word, n in copies.items():
            found[block.hashes == context_hash(word)] += int(mixed(np.array([block.number]))[0] % n)
        return found % parts

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Copies of the model's rows of words too frequent for one part, for the other parts that have them."""
        for batch in batches:
            home = batch.column("part").to_numpy()
            for word, n in copies.items():
                for at in np.flatnonzero(home == context_hash(word) % parts):
                    own = batch.slice(at, 1)
                    if word not in (names := _names(own)):
                        continue
                    i, row = names.index(word), {c: _numbers(own, c) for c in batch.schema.names if c not in ("part", "words")}
                    one = {c: row[c][i : i + 1] for c in ("total", "each", "others")} | {"parent": row["parent"][SAMPLES * i : SAMPLES * (i + 1)]}
                    for lengths, some in (("each", ("context", "probability")), ("others", ("rare", "own"))):
                        start = row[lengths][:i].sum()
                        one |= {c: row[c][start : start + row[lengths][i]] for c in some}
                    lists = {"words": pa.array([word], pa.binary()), **{c: _listed(v, [len(v)], c) for c, v in one.items()}}
                    for part in (home[at] + np.arange(1, n)) % parts:
                        yield pa.RecordBatch.from_pydict({"part": pa.array([part]), **lists}).select(batch.schema.names)

    def ask(turn: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            part = part_of(block)
            if (found := block.dealt(part, (part % TURNS == turn)[block.token], occurrences=True)) is not None:
                yield found

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The contexts of held-out texts; those of the others are in the model's rows."""
        for block in _blocks(batches):
            part, context = part_of(block)[block.token[block.held]], block.contexts[block.before[block.held]]
            yield _asked_for(part[context < 0], context[context < 0], shards)

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, vocabulary, opening, unknown = shared.value
        keys, sums, waiting = np.zeros(0, dtype=np.int64), np.zeros((0, 4)), []

        def added() -> tuple[np.ndarray, np.ndarray]:
            return _added([(keys, sums), *waiting])

        def rows(own: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
            blocks, each = np.unique(own // DOCUMENTS, return_counts=True)
            kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64())
            lists = [_grouped((own % DOCUMENTS).astype(np.int16), each, pa.int16())]
            lists += [_grouped(v.astype(k.to_pandas_dtype()), each, k) for v, k in zip(values.T, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(blocks), *lists], ["block", "document", *MEASURES])

        part, met, lookup = None, ([], []), None
        for batch in batches:
            for at in range(batch.num_rows):
                run = batch.slice(at, 1)
                part_at, kind = run.column("part")[0].as_py(), run.column("kind")[0].as_py()
                if part_at != part:
                    part, met, lookup = part_at, ([], []), None
                if kind < 2:
                    met[kind].append(run)
                    continue
                lookup = lookup or Lookup(*met, opening, unknown)
                each, context, n, document = (_numbers(run, c) for c in ("each", "context", "n", "document"))
                word = np.array([lookup.words.get(w, 0) for w in _names(run)], dtype=np.int64)
                total, row = lookup.total[word], np.repeat(np.arange(len(word)), each)
                base = np.log10((total + 1) / (tokens + vocabulary + 1))
                of_pair = ((total > 0)[row], base[row], np.log10(lookup.probability(word[row], context)))
                found = [np.bincount(document), *(np.bincount(document, weights=np.repeat(v, n)) for v in of_pair)]
                there = np.flatnonzero(found[0])
                waiting.append((run.column("block")[0].as_py() * DOCUMENTS + there, np.stack([v[there] for v in found], axis=1)))
                if sum(len(k) for k, _ in waiting) > HELD_ENTRIES // 4:
                    (keys, sums), waiting = added(), []
                    if len(keys) > HELD_ENTRIES // 2:
                        yield rows(keys, sums)
                        keys, sums = keys[:0], sums[:0]
        yield rows(*added())

    blocks = posted.select("block", "held", "lengths", "words", "token", "frequent")
    homes = sorted({int(context_hash(word) % parts) for word in copies})
    rows = model.parts.unionByName(model.parts.where(F.col("part").isin(homes)).mapInArrow(spread, MODEL)) if copies else model.parts
    met_in_held = blocks.mapInArrow(held, WANTED)
    back = counted(_wanted(rows, met_in_held, model.backing, shards), "wanted", clean=True, codec="zstd")[0]

    def taken(turn: int) -> DataFrame:
        own = F.col("part") % TURNS == turn
        asked = blocks.mapInArrow(lambda batches: ask(turn, batches), ASKED)
        kinds = [df.withColumn("kind", F.lit(i)) for i, df in enumerate((back.where(own), rows.where(own), asked))]
        met = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kinds)
        sums = met.repartition(-(-parts // TURNS), "part").sortWithinPartitions("part", "kind").mapInArrow(sum_up, SUMS)
        return counted(sums, "sums", clean=True)[0]

    sums = reduce(DataFrame.unionByName, [taken(turn) for turn in range(TURNS)])
    discard(back)
    scored = sums.unionByName(posted.select("block", "doc_ids", "held"), allowMissingColumns=True).repartition("block").mapInArrow(_finish, SCORED)
    return scored.withColumn("train_tokens", F.lit(model.tokens).cast("long"))
