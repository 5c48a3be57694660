"""Documents as flat token files: unsigned ids, 64-bit document offsets, and a manifest of the parts.

Rows are dealt to parts by ranges of doc_id, so the parts in order are the corpus in ascending doc_id order. Each part is
three flat little-endian files: ids in 16 bits where the vocabulary fits and 32 otherwise, offsets of its documents, and
doc_ids. The manifest names the width and says how many documents and ids precede, which are prefix sums over one row a part. A file counts only if the manifest names it: every attempt of a
task writes names of its own, so what a lost executor leaves is never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.common import columns, texts
from basketry.llm.tokenizer import encoder

NO_ID = np.iinfo(np.int64).min
MANIFEST = "part int, name string, width int, n_docs long, n_ids long"
DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_token_files(documents: DataFrame, folder: str, tokenizer_path: str, end_id: int) -> DataFrame:
    """Encode every text, add `end_id`, write the parts and their manifest to `folder`; returns the manifest.

    A null text is empty: its document is `end_id` alone. Documents without an id come first. Rows that repeat a doc_id
    are documents of their own, side by side. An empty table gives an empty manifest. `folder` has to be reached by all
    executors.
    """

    def write_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encode = TaskContext.get().partitionId(), encoder(tokenizer_path).encode
        width = 2 if max(encoder(tokenizer_path).n_ids - 1, end_id) < 2**16 else 4
        end = np.array([end_id], dtype="<u4").tobytes()
        store, root = fs.FileSystem.from_uri(folder)
        name, streams = f"part-{part:06d}-{uuid.uuid4().hex}", {}
        n_docs, n_ids = 0, 0
        for batch in batches:
            if not streams:
                store.create_dir(root, recursive=True)
                streams = {kind: store.open_output_stream(f"{root}/{name}.{kind}") for kind in ("ids", "offsets", "docs")}
                streams["offsets"].write(np.zeros(1, dtype="<i8").tobytes())
            lengths = []
            for text in batch.column("text").to_pylist():
                ids = encode(text) + end
                streams["ids"].write(np.frombuffer(ids, dtype="<u4").astype(f"<u{width}").tobytes())
                lengths.append(len(ids) // 4)
            streams["offsets"].write((n_ids + np.cumsum(lengths)).astype("<i8").tobytes())
            streams["docs"].write(np.array([NO_ID if d is None else d for d in columns(batch, "doc_id")[0]], dtype="<i8").tobytes())
            n_docs, n_ids = n_docs + len(lengths), n_ids + sum(lengths)
        for stream in streams.values():
            stream.close()
        if streams:
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "name": [name], "width": pa.array([width], pa.int32()), "n_docs": [n_docs], "n_ids": [n_ids]})

    spread = F.xxhash64("text")
    ordered = texts(documents).repartitionByRange("doc_id", spread).sortWithinPartitions("doc_id", spread, "text")
    parts = f"{folder}/parts"
    ordered.mapInArrow(write_part, MANIFEST).write.parquet(parts)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = documents.sparkSession.read.schema(MANIFEST).parquet(parts).select(
        "*",
        F.coalesce(F.sum("n_docs").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("ids_before"),
    )
    manifest.write.parquet(f"{folder}/manifest")
    return read_manifest(documents.sparkSession, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{MANIFEST}, docs_before long, ids_before long").parquet(f"{folder}/manifest")


class Part:
    """The flat files of one part: memory-mapped where the folder is a file system's, read by range elsewhere."""

    def __init__(self, folder: str, name: str, width: int):
        self.store, self.root = fs.FileSystem.from_uri(folder)
        self.name, self.width = name, width
        self.offsets, self.docs = self._all("offsets"), self._all("docs")
        path = f"{self.root}/{name}.ids"
        self.mapped = np.memmap(path, dtype=f"<u{width}", mode="r") if isinstance(self.store, fs.LocalFileSystem) else None
        self.file = None if self.mapped is not None else self.store.open_input_file(path)

    def _all(self, kind: str) -> np.ndarray:
        with self.store.open_input_stream(f"{self.root}/{self.name}.{kind}") as stream:
            return np.frombuffer(stream.read(), dtype="<i8")

    def ids(self, document: int) -> np.ndarray:
        start, end = map(int, self.offsets[document : document + 2])
        if self.mapped is not None:
            return self.mapped[start:end]
        return np.frombuffer(self.file.read_at((end - start) * self.width, start * self.width), dtype=f"<u{self.width}")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Place, length and checksum of every document as its part's files hold it."""

    def read_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, width, ids_before in zip(*columns(batch, "name", "width", "ids_before"), strict=True):
                part = Part(folder, name, width)
                lengths = np.diff(part.offsets)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array([None if d == NO_ID else int(d) for d in part.docs], pa.int64()),
                        "start": ids_before + part.offsets[:-1],
                        "n_tokens": lengths,
                        "ids_crc32": pa.array([zlib.crc32(part.ids(i).astype("<u4")) for i in range(len(lengths))], pa.int64()),
                    }
                )

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return read_manifest(spark, folder).repartition(tasks).mapInArrow(read_part, DIGEST)
