"""The corpus pipeline: documents through quality, repeated lines, near copies, benchmark passages and packing.

Every stage but the last returns the columns of its input. Columns the stages do not know travel inside a struct, so that
no name of theirs can clash. Null and empty texts pass the middle stages unchanged; whether they stay in the first depends
on their score. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import decontaminate, line_dedup, near_dedup, packing, quality
from basketry.llm.common import written
from basketry.llm.queries import tokenizer_path
from basketry.session import tune

LEAST_SCORE = 0.3
ORACLE_SQL = None  # SQL cannot express the classifier; the stages are tested against brute force


def _keyed(docs: DataFrame) -> DataFrame:
    """Each row as one struct, with its doc_id and the print of its text as the operators make it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("print"))


def _among(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of `docs` joined `how` with (doc_id, print) keys, in which two null ids are equal."""
    rows, other = _keyed(docs), keys.select(F.col("doc_id").alias("k"), F.col("print").alias("p"))
    return rows.join(other, F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("print") == F.col("p")), how)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is LEAST_SCORE or more."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs, model, F.struct("*").alias("row"))
    return scored.where(F.col("score") >= LEAST_SCORE).select("row.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that another one keeps; n_chars follows the text."""
    rest = [c for c in docs.columns if c != "text"]
    lines = line_dedup.dedup_lines(docs, F.struct(*rest).alias("row"))
    made = {"text": F.col("kept")}
    if "n_chars" in rest:
        made["n_chars"] = F.when(F.col("n_dropped") > 0, F.char_length("kept")).otherwise(F.col("row.n_chars"))
    return lines.select(*((made[c].cast(docs.schema[c].dataType) if c in made else F.col("row")[c]).alias(c) for c in docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; documents without words all stay."""
    linked = near_dedup.near_duplicates(docs, size=5, percent=80).where(F.col("root").isNotNull())
    chosen = linked.groupBy("root").agg(F.min(F.struct("doc_id", "print")).alias("first")).select("first.*")
    has_words = F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = _among(docs.where(has_words), chosen, "inner").dropDuplicates(["k", "p"])
    return kept.select("row.*").union(docs.where(~has_words))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    cut, _ = decontaminate.windows(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _among(docs, decontaminate.hits(docs, cut).select("doc_id", "print").distinct(), "left_anti").select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(docs, tokenizer_path(), end_id=0, capacity=1024)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_repeated_lines),
    ("near-duplicate removal", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written to the shared folder and read again by the next."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
