"""Results remembered by content, deletion, and tables that are replaced whole."""

import time
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from basketry.catalog import queries
from basketry.session import materialise, shared_folder
from basketry.sources.sample_tables import raw_table
from basketry.sources.versioned import Conflict, VersionedTable
from basketry.store import Memo, checkpoint_files, discard, listing

FOLDER = "/root/testdata/sf0.001"


def local(path):
    return Path(path.removeprefix("file:"))


def files(folder):
    return [p for p in local(folder).rglob("*") if p.is_file()]


def test_memo_follows_the_content(spark, tmp_path):
    path, built = str(tmp_path / "t"), []
    memo = Memo(spark)

    def total():
        table = spark.read.parquet(path)
        return memo.get("total", [table], lambda: built.append(1) or table.agg(F.sum("id").alias("s")))

    spark.range(10).write.parquet(path)
    first = total()
    assert first.first().s == total().first().s == 45 and len(built) == 1
    time.sleep(1.1)  # times of change may be whole seconds
    spark.range(20).write.mode("overwrite").parquet(path)
    assert total().first().s == 190 and len(built) == 2
    assert first.first().s == 45  # still there: its reader may come back
    assert files(memo.folder)
    memo.close()
    assert not local(memo.folder).exists()


def test_memo_keeps_plans_apart_and_counts_readers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    memo, table = Memo(spark), spark.read.parquet(path)
    even = memo.get("rows", [table.where("id % 2 = 0")], lambda: table.where("id % 2 = 0"))
    odd = memo.get("rows", [table.where("id % 2 = 1")], lambda: table.where("id % 2 = 1"))
    assert {r.id for r in even.collect()} | {r.id for r in odd.collect()} == set(range(10))
    with memo.lease("all", [table], lambda: table) as outer:
        spark.range(30).write.mode("append").parquet(path)
        newer = spark.read.parquet(path)
        with memo.lease("all", [newer], lambda: newer) as inner:
            assert inner.count() == 40 and outer.count() == 10  # the older one has a reader
        before = len(files(memo.folder))
    assert len(files(memo.folder)) < before  # and goes with it
    memo.close()
    assert not local(memo.folder).exists()


def test_model_queries_follow_rewritten_tables(spark, tmp_path):
    queries.forget_models()
    for name in ("customer", "orders"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    one = queries.QUERIES["kmeans_profile"](spark, str(tmp_path)).agg(F.sum("customers")).first()[0]
    assert one == queries.QUERIES["kmeans_profile"](spark, str(tmp_path)).agg(F.sum("customers")).first()[0]
    time.sleep(1.1)
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").where("o_custkey % 3 > 0")
    orders.write.mode("overwrite").parquet(str(tmp_path / "orders.parquet"))
    two = queries.QUERIES["kmeans_profile"](spark, str(tmp_path)).agg(F.sum("customers")).first()[0]
    base = queries.Shop(spark, str(tmp_path)).base.where("customer_id IS NOT NULL").count()
    assert two == base < one
    folder = next(iter(queries._MEMOS.values())).folder
    queries.forget_models()
    assert not local(folder).exists() and not queries._MEMOS


def test_discarded_checkpoints_are_gone(spark):
    kept, _ = materialise(spark.range(1000))
    (folder,) = checkpoint_files(kept)
    assert files(folder) and folder.startswith(("file:", "/")) and shared_folder(spark) in folder
    discard(kept)
    assert not local(folder).exists()


def test_listing_names_size_and_time(spark, tmp_path):
    (tmp_path / "a").write_text("four")
    found = listing(spark, [str(tmp_path / "b"), str(tmp_path / "a")])
    assert [f[:2] for f in found] == [(str(tmp_path / "a"), 4), (str(tmp_path / "b"), -1)] and found[0][2] > 0


def month_rows(spark, *rows):
    return spark.createDataFrame([(k, v, date(2024, m, 1).year, m) for k, v, m in rows], "k int, v string, year int, month int")


def test_versions_replace_whole_tables_and_touched_months(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    by = ["year", "month"]
    assert table.write(month_rows(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3)), by) == 3
    old = table.read()
    assert table.write(month_rows(spark, (4, "d", 2), (5, "e", 2), (6, "f", 4)), by, only_touched=True) == 3
    rows = lambda df: sorted((r.k, r.v, r.month) for r in df.collect())
    assert rows(table.read()) == [(1, "a", 1), (3, "c", 3), (4, "d", 2), (5, "e", 2), (6, "f", 4)]
    assert rows(old) == rows(table.read(1)) == [(1, "a", 1), (2, "b", 2), (3, "c", 3)]
    table.write(month_rows(spark, (7, "g", 1)), by)
    assert rows(table.read()) == [(7, "g", 1)] and table.versions() == [1, 2, 3]
    assert table.vacuum() == 2 and rows(table.read()) == [(7, "g", 1)] and table.versions() == [3]
    with pytest.raises(ValueError):
        table.write(month_rows(spark, (8, "h", 1)).drop("v"), by, only_touched=True)
    pruned = table.read().where("month = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in pruned


def test_a_failing_write_leaves_the_old_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.write(spark.range(100))
    before = sorted(p.name for p in (tmp_path / "t").iterdir())
    broken = spark.range(100).selectExpr("if(id = 99, raise_error('broken row'), id) as id")
    with pytest.raises(Exception, match="broken row"):
        table.write(broken)
    assert table.read().count() == 100 and table.versions() == [1]
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == before


def test_the_faster_writer_wins(spark, tmp_path, monkeypatch):
    table, other = VersionedTable(spark, str(tmp_path / "t")), VersionedTable(spark, str(tmp_path / "t"))
    table.write(spark.range(1))
    seen = table.versions()
    other.write(spark.range(2))
    monkeypatch.setattr(table, "versions", lambda: seen)  # read before the other was done
    with pytest.raises(Conflict):
        table.write(spark.range(3))
    monkeypatch.undo()
    assert table.read().count() == 2 and len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("write-")]) == 2
    assert sorted(p.name for p in (tmp_path / "t" / "_versions").iterdir() if not p.name.endswith(".crc")) == ["000000000001.json", "000000000002.json"]


def test_an_empty_table_has_its_columns(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.write(month_rows(spark, (1, "a", 1)).limit(0), ["year", "month"])
    assert table.read().columns == ["k", "v", "year", "month"] and table.read().count() == 0
