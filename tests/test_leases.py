"""What lazy results have stored goes when nobody can read it any more."""

import os
import time
from pathlib import Path

from checks.registry import QUERIES
from tests.conftest import SMALL
from zonewright.session import materialize, release_unread, shared_folder, sweep


def folder(spark):
    return Path(shared_folder(spark).removeprefix("file://").removeprefix("file:"))


def stored(spark):
    return {p.name for p in folder(spark).iterdir()}


def test_calls_leave_no_folder_behind(spark):
    release_unread(spark)
    before = stored(spark)
    rows = {tuple(sorted(map(repr, QUERIES["mart_spatial_comparison"](spark, SMALL).collect()))) for _ in range(20)}
    assert len(rows) == 1 and len(stored(spark) - before) >= 20
    for _ in range(5):  # a collector may be late
        release_unread(spark)
    assert not {n.split("-")[0] for n in stored(spark) - before} & {"metrics", "cell_stats"}


def test_a_reader_keeps_its_own(spark):
    kept = materialize(spark.range(1000).selectExpr("id", "id % 7 AS k"), "kept")
    gone = materialize(spark.range(10), "gone")
    derived = kept.where("k = 3").groupBy("k").count()
    rows = kept.where("k = 1").toLocalIterator()
    next(rows)
    del kept, gone
    names = {p.rsplit("/", 1)[-1].split("-")[0] for p in release_unread(spark)}
    assert "gone" in names and "kept" not in names
    assert derived.first()["count"] == 143 and len(list(rows)) == 142
    del derived, rows
    assert "kept" in {p.rsplit("/", 1)[-1].split("-")[0] for p in release_unread(spark)}


def test_sweep_drops_what_ended_sessions_left(spark):
    old, new = (folder(spark) / f"{name}-{'0' * 31}{i}" for i, name in enumerate(("old", "new")))
    other = folder(spark) / "not-ours"
    for path in (old, new, other):
        path.mkdir()
    long_ago = time.time() - 50 * 3600
    for path in (old, other):
        os.utime(path, (long_ago, long_ago))
    held = materialize(spark.range(5), "held")
    name = held.inputFiles()[0].split("/")[-2]
    os.utime(folder(spark) / name, (long_ago, long_ago))
    dropped = sweep(spark, hours=48)
    assert old.name in dropped and name not in dropped
    assert new.exists() and other.exists() and not old.exists() and held.count() == 5
