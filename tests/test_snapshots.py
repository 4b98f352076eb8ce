"""Refreshes that stop midway, old snapshots, and counts from footers."""

from datetime import datetime, timedelta, timezone

import pytest

from tests.test_sources import lake, raw  # noqa: F401
from zonewright.operators import layout
from zonewright.plans import marts, refresh
from zonewright.sources import readers, snapshots

MARTS = ("mart_deliveries", "mart_kpis", "mart_district", "mart_h3", "mart_grid", "mart_spatial_comparison")


def rows(spark, database):
    """All marts, by the pointer and by their views."""
    return {
        name: (sorted(map(repr, readers.read_mart(spark, database, name).collect())), sorted(map(repr, spark.table(f"{database}.{name}").collect())))
        for name in MARTS
    }


def schemas(spark, database):
    return {r[0] for r in spark.sql(f"SHOW DATABASES LIKE '{database}__*'").collect()}


@pytest.fixture
def built(spark, raw, request):  # noqa: F811
    database = f"safe_{abs(hash(request.node.name))}"
    refresh.load(spark, raw, database)
    refresh.build(spark, database)
    return database


def test_views_and_pointer_show_the_same(spark, built):
    assert all(a == b for a, b in rows(spark, built).values())
    assert set(snapshots.current(spark, built)) == {"raw", "marts"}
    assert not set(layout.COLUMNS) & set(spark.table(f"{built}.mart_h3").columns)


@pytest.mark.parametrize("where", ["plan", "job"])
def test_a_build_that_fails_midway_leaves_all_marts(spark, built, monkeypatch, where):
    before, at = rows(spark, built), schemas(spark, built)

    def fails(metrics):
        if where == "plan":
            raise RuntimeError("stopped")
        return marts.kpis(metrics).selectExpr("raise_error('stopped') AS x")

    monkeypatch.setattr(marts, "grid", fails)
    with pytest.raises(Exception, match="stopped"):
        refresh.build(spark, built)
    assert rows(spark, built) == before and schemas(spark, built) == at


def test_a_build_whose_driver_dies_leaves_all_marts(spark, built, monkeypatch):
    before, at = rows(spark, built), schemas(spark, built)
    monkeypatch.setattr(marts, "grid", lambda metrics: (_ for _ in ()).throw(KeyboardInterrupt))
    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(snapshots.Snapshot, "drop", lambda self: None)  # nobody is left to clean up
        refresh.build(spark, built)
    assert rows(spark, built) == before
    [left] = schemas(spark, built) - at
    assert snapshots.drop_old(spark, built, hours=1) == []  # it may be a build that still runs
    later = datetime.now(timezone.utc) + timedelta(hours=2)
    assert snapshots.drop_old(spark, built, hours=1, now=later) == [left]
    assert rows(spark, built) == before and schemas(spark, built) == at


def test_marts_that_do_not_add_up_are_not_published(spark, built, monkeypatch):
    before = rows(spark, built)
    whole = marts.h3
    monkeypatch.setattr(marts, "h3", lambda metrics: whole(metrics.limit(1)))
    with pytest.raises(ValueError, match="mart_h3"):
        refresh.build(spark, built)
    assert rows(spark, built) == before


def test_a_reader_keeps_its_snapshot(spark, raw, built):  # noqa: F811
    reader = readers.read_mart(spark, built, "mart_kpis")
    fewer = raw | {"raw_deliveries": raw["raw_deliveries"].where("order_id = 'o1'")}
    refresh.load(spark, fewer, built)
    refresh.build(spark, built)
    assert reader.first()["total_deliveries"] == 5
    assert readers.read_mart(spark, built, "mart_kpis").first()["total_deliveries"] == 1
    assert spark.table(f"{built}.mart_kpis").first()["total_deliveries"] == 1
    later = datetime.now(timezone.utc) + timedelta(hours=30)
    assert len(snapshots.drop_old(spark, built, hours=24, now=later)) == 2
    assert readers.read_mart(spark, built, "mart_kpis").first()["total_deliveries"] == 1


def test_a_table_of_its_own_is_replaced_by_a_view(spark):
    database = "older_layout"
    spark.sql(f"CREATE DATABASE {database}")
    spark.range(3).write.saveAsTable(f"{database}.t")
    assert snapshots.table(spark, database, "t").count() == 3
    with snapshots.refresh(spark, database, "marts") as snapshot:
        snapshot.write(spark.range(5), "t")
    assert spark.table(f"{database}.t").count() == 5 == snapshots.table(spark, database, "t").count()


def test_counts_come_from_footers(spark, built):
    """No column is read for a count of a stored table: the files' footers know their rows."""
    with snapshots.refresh(spark, built, "counted") as snapshot:
        snapshot.write(spark.range(1000).selectExpr("id", "string(id) AS text"), "a")
        snapshot.write(spark.range(10), "b")
        counts = snapshot.counts()
        assert dict(map(tuple, counts.collect())) == {"a": 1000, "b": 10}
        plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<>") == plan.count("FileScan parquet") > 0
