"""Line dedup through its runs: repeated rows, several compactions, and the SQL's answer."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketry.llm import line_dedup
from basketry.llm.oracle import ORACLE

LINE = "a line of more than twenty characters "


def result(spark, rows, **how):
    docs = spark.createDataFrame([(*r, "x", b"y", 3) for r in rows], "doc_id long, text string, keeper string, hash binary, batch int").repartition(5)
    kept = line_dedup.dedup_lines(docs, **how)
    return sorted(map(tuple, kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256)).collect()), key=repr)


def expected(rows):
    """The query's SQL; it groups by doc_id, so ids must not recur."""
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    return sorted(map(tuple, con.execute(f"select doc_id, n_lines, n_dropped, kept_sha256 from ({ORACLE['op1_line_dedup']})").fetchall()), key=repr)


def some_rows(many, seed=1):
    pick = random.Random(seed)
    pool = [LINE + str(i) for i in range(many // 3)]
    rows = []
    for i in pick.sample(range(10 * many), many):
        lines = pick.choices(pool, k=pick.randint(0, 6)) + [pick.choice(["", " short", LINE.upper() + "HOT ", f"\t{LINE}hot", f"{LINE}own {i}"])]
        rows.append((i, "\n".join(pick.sample(lines, len(lines)))))
    return rows


@pytest.mark.parametrize("batches", [None, 1, 7, 13])
def test_any_number_of_batches_gives_the_same(spark, batches):
    rows = some_rows(150)
    assert result(spark, rows, batches=batches) == expected(rows)


def test_runs_carry_counts_and_keepers_through_compactions(spark):
    rows = some_rows(120, seed=2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    runs = line_dedup.line_runs(docs, batches=10, fanout=2)
    assert runs.compactions > 3 and len(runs.levels) > 2
    held = runs.all().collect()
    hashes = [bytes(r["hash"]) for r in held]
    assert len(hashes) == len(set(hashes))
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").lower()  # noqa: E731  the lines are ASCII
    docs_of = {}
    for doc_id, text in rows:
        for line in text.split("\n"):
            if len(key(line)) >= 20:
                docs_of.setdefault(key(line), set()).add(doc_id)
    assert len(held) == len(docs_of)
    assert sorted(r["keeper"] for r in held) == sorted(max(ids) for ids in docs_of.values())
    found = sorted(r["keeper"] for r in runs.held_by(3).collect())
    assert found == sorted(max(ids) for ids in docs_of.values() if len(ids) >= 3)
    runs.close()


def test_repeated_rows_are_one_document(spark):
    rows = [(1, LINE), (1, LINE), (2, LINE)]
    assert [r[2] for r in result(spark, rows)] == [0, 0, 0]  # two documents hold it
    assert [r[2] for r in result(spark, [*rows, (3, f"x\n{LINE}")])] == [1, 1, 1, 0]
    assert [r[2] for r in result(spark, [(None, LINE), (None, LINE), (4, LINE), (5, LINE)])] == [1, 0, 1, 1]  # 4, 5 and those without an id


def test_more_rows_make_more_batches(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "ROWS", 10)
    rows = spark.range(1000).selectExpr("id as doc_id")
    assert len(line_dedup._batch_edges(rows, None)) + 1 == line_dedup.LEAST_BATCHES + 6
    assert len(line_dedup._batch_edges(rows.limit(0), None)) == 0
