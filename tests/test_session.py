from types import SimpleNamespace

import pytest

from basketry.session import ADAPTIVE, _ensure_checkpoint_dir, materialise, small_side


def fake(master, setting=None, current=None):
    chosen = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: current, setCheckpointDir=chosen.append)
    values = {"spark.checkpoint.dir": setting, "spark.sql.warehouse.dir": "hdfs:///warehouse/"}
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, default=None: values[name]))
    return session, chosen


def test_shared_folder_is_read_from_the_session():
    session, chosen = fake("spark://host", "hdfs:///shared")
    _ensure_checkpoint_dir(session)
    assert chosen == ["hdfs:///shared"]


@pytest.mark.parametrize("master", ["spark://host", "local[2]"])
def test_unset_folder_lies_beside_the_tables(master):
    session, chosen = fake(master)
    _ensure_checkpoint_dir(session)
    assert chosen == ["hdfs:///warehouse/_intermediate"]


def test_a_machines_own_disk_is_refused_on_a_cluster():
    session, _ = fake("spark://host")
    values = {"spark.checkpoint.dir": None, "spark.sql.warehouse.dir": "file:/tmp/warehouse"}
    session.conf.get = lambda name, default=None: values[name]
    with pytest.raises(ValueError):
        _ensure_checkpoint_dir(session)
    session.sparkContext.master = "local[4]"
    _ensure_checkpoint_dir(session)


def test_events_do_not_follow_the_session_zone(spark):
    from basketry.catalog.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    expected = sorted(map(tuple, QUERIES["fct_events"](spark, folder).collect()), key=repr)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert sorted(map(tuple, QUERIES["fct_events"](spark, folder).collect()), key=repr) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_existing_folder_is_kept():
    session, chosen = fake("spark://host", "hdfs:///shared", "hdfs:///shared/app")
    _ensure_checkpoint_dir(session)
    assert not chosen


def test_materialise_counts_and_cuts_lineage(spark):
    kept, rows = materialise(spark.range(1000).where("id % 3 = 0"))
    assert rows == 334 == kept.count()
    assert "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_only_counted_small_sides_are_marked_for_broadcast(spark, monkeypatch):
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(small_side(spark.range(10)))
    monkeypatch.setattr("basketry.session.BROADCAST_ROWS", 9)
    assert not hinted(small_side(spark.range(10)))


def test_skew_settings_are_applied(spark):
    assert all(spark.conf.get(name) == value for name, value in ADAPTIVE.items())
