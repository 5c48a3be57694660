"""The stages of the corpus pipeline on a small table, each against what it must do to its own input."""

import re

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"


def windows(words, size=10):
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size, 0) + 1)} if words else set()


def simple(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({c: c + 32 for c in range(65, 91)}))


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).checkpoint()
        assert docs.columns == names
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    good, lines, single, clean = kept.values()
    assert sum(labels[i] == 1 for i in good if i in labels) >= 0.98 * sum(q == 1 for q in labels.values())
    assert sum(labels[i] == 0 for i in good if i in labels) <= 0.3 * sum(q == 0 for q in labels.values())
    assert lines.keys() == good.keys() and any(lines[i] != good[i] for i in lines)
    assert single.keys() < lines.keys() and len(set(single.values())) >= len(single) - sum(not t.split() for t in single.values())
    items = [simple(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    sought = {w for words in items for w in windows(words)}
    lengths = {len(w) for w in sought}
    dirty = {i for i, t in single.items() if any(windows(simple(t), n) & sought for n in lengths)}
    assert clean.keys() == single.keys() - dirty
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {p["doc_id"] for p in pieces} == clean.keys()


def test_empty_and_odd_tables(spark):
    rows = [(1, "some words in a row that go on", "x"), (None, None, "y"), (2, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "text", "row"] and docs.count() == 3
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
