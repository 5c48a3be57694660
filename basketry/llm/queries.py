"""The registered queries of this package: each operator over its whole table, with the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import decontaminate, hard_negatives, html_text, language_model, line_dedup, manifest, near_dedup, packing, quality, substring_dedup, token_files, topk, url_filters
from basketry.llm.common import new_folder
from basketry.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Register `build(table)`, where table(name) reads a table of the given folder."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        tune(spark)
        return build(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))

    QUERIES[build.__name__] = run
    return build


def tokenizer_path() -> str:
    """The tokenizer file of the contracts; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_line_dedup(table) -> DataFrame:
    kept = line_dedup.dedup_lines(table("documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_exact_topk(table) -> DataFrame:
    vectors = topk.integer_vectors(table("embeddings"))
    return topk.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


@query
def op3_language_model(table) -> DataFrame:
    return language_model.score(table("documents"))


@query
def op4_html_extraction(table) -> DataFrame:
    return html_text.extract_text(table("pages"))


@query
def op5_decontamination(table) -> DataFrame:
    judged = decontaminate.contamination(table("documents"), table("benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op6_near_dedup(table) -> DataFrame:
    linked = near_dedup.near_duplicates(table("documents"), size=3, percent=85)
    return linked.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query
def op7_substring_dedup(table) -> DataFrame:
    kept = substring_dedup.dedup_substrings(table("documents"), window=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_packing(table) -> DataFrame:
    return packing.pack(table("documents"), tokenizer_path(), end_id=0, capacity=1024)


@query
def op9_quality(table) -> DataFrame:
    documents = table("documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = quality.fit(documents.where(~held_out), table("labels"))
    scored = quality.score(documents, model, F.col("doc_id").cast("long").alias("doc_id"))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op10_token_files(table) -> DataFrame:
    documents = table("documents")
    folder = new_folder(documents.sparkSession, "token-files")
    token_files.write_token_files(documents, folder, tokenizer_path(), end_id=2)
    return token_files.read_documents(documents.sparkSession, folder)


URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


@query
def op11_url_filters(table) -> DataFrame:
    return url_filters.judged(table("pages"), URL_RULES)


@query
def op12_hard_negatives(table) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.integer_rows(table("embeddings"), label)
    return hard_negatives.hard_negatives(rows, rows.where(F.col("vec_id") % 50 == 0))


@query
def op13_merkle_manifest(table) -> DataFrame:
    documents = table("documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    proven = manifest.manifest(manifest.document_leaves(documents, tampered))
    verified = F.col("folded_root") == F.col("root")
    return proven.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", verified.alias("verified"))
