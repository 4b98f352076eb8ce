"""Refreshes that never lose a table: every build goes to a fresh place, and a pointer is moved last.

A snapshot is a schema of its own below the database's location. It is filled,
audited and only then named in the database's properties, which is one step
in the catalog. Readers go by that name; views of the tables' names are moved after it. A build that
stops anywhere before leaves the old snapshot in place, and one that is no longer named is dropped
by age, when readers that began with it have ended.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from zonewright.sources.sinks import row_counts

PROPERTY = "zonewright.snapshot"
STAMP = "%Y%m%dt%H%M%S"

# (database, layer, stamp) in a snapshot's name.
_NAME = re.compile(r"^(?P<database>.+)__(?P<layer>[a-z]+)_(?P<stamp>\d{8}t\d{6})_[0-9a-f]{8}$")


class Snapshot:
    """A schema that is being filled."""

    def __init__(self, spark: SparkSession, database: str, layer: str):
        self.spark, self.database, self.layer = spark, database, layer
        stamp = datetime.now(timezone.utc).strftime(STAMP)
        self.name = f"{database}__{layer}_{stamp}_{uuid.uuid4().hex[:8]}".lower()
        self.tables: list[str] = []

    def create(self) -> None:
        at = self.spark.catalog.getDatabase(self.database).locationUri.rstrip("/")
        self.spark.sql(f"CREATE DATABASE `{self.name}` LOCATION '{at}/{self.name}'")

    def write(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Store a table and return it as it is stored."""
        df.write.format("parquet").partitionBy(*partition_by).saveAsTable(f"`{self.name}`.`{table}`")
        self.tables.append(table)
        return self.table(table)

    def table(self, table: str) -> DataFrame:
        return self.spark.table(f"`{self.name}`.`{table}`")

    def counts(self) -> DataFrame:
        """Rows of every table, taken from the files' footers."""
        return row_counts({name: self.table(name) for name in self.tables})

    def drop(self) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.name}` CASCADE")


@contextmanager
def refresh(
    spark: SparkSession, database: str, layer: str, audit: Callable[[Snapshot], None] | None = None, hidden: Sequence[str] = ()
) -> Iterator[Snapshot]:
    """A snapshot to fill; it becomes the current one of its layer if all goes well and the audit raises nothing.

    ``hidden`` columns are left out of the views. After a failure the new snapshot is dropped; if even that
    doesn't happen, as the driver is gone, :func:`drop_old` finds it.
    """
    snapshot = Snapshot(spark, database, layer)
    snapshot.create()
    try:
        yield snapshot
        if audit:
            audit(snapshot)
    except BaseException:
        snapshot.drop()
        raise
    publish(snapshot, hidden)


def publish(snapshot: Snapshot, hidden: Sequence[str] = ()) -> None:
    """Names the snapshot as the current one, then moves the views."""
    spark, database = snapshot.spark, snapshot.database
    spark.sql(f"ALTER DATABASE `{database}` SET DBPROPERTIES ('{PROPERTY}.{snapshot.layer}' = '{snapshot.name}')")
    views = {t.name for t in spark.catalog.listTables(database) if t.tableType == "VIEW"}
    for table in snapshot.tables:
        if table not in views:  # a table of its own, from before there were snapshots
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")
        columns = ", ".join(f"`{c}`" for c in snapshot.table(table).columns if c not in hidden)
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{table}` AS SELECT {columns} FROM `{snapshot.name}`.`{table}`")


def current(spark: SparkSession, database: str) -> dict[str, str]:
    """Name of the current snapshot of each layer."""
    described = spark.sql(f"DESCRIBE DATABASE EXTENDED `{database}`").collect()
    properties = next((r["info_value"] for r in described if r["info_name"] == "Properties"), "")
    return dict(re.findall(rf"\({re.escape(PROPERTY)}\.(\w+),\s*([^)]+)\)", properties))


def table(spark: SparkSession, database: str, name: str) -> DataFrame:
    """A table of the current snapshots with all it stores; one outside of them under its own name."""
    for snapshot in current(spark, database).values():
        if spark.catalog.tableExists(f"`{snapshot}`.`{name}`"):
            return spark.table(f"`{snapshot}`.`{name}`")
    return spark.table(f"`{database}`.`{name}`")


def drop_old(spark: SparkSession, database: str, hours: float, now: datetime | None = None) -> list[str]:
    """Drops the database's snapshots that are not current and were begun over ``hours`` ago; returns their names.

    A build that still runs must be younger than that, and so must a reader's snapshot.
    """
    limit = (now or datetime.now(timezone.utc)) - timedelta(hours=hours)
    kept, dropped = set(current(spark, database).values()), []
    for row in spark.sql(f"SHOW DATABASES LIKE '{database.lower()}__*'").collect():
        name = row[0]
        found = _NAME.match(name)
        if not found or found["database"] != database.lower() or name in kept:
            continue
        if datetime.strptime(found["stamp"], STAMP).replace(tzinfo=timezone.utc) < limit:
            spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
            dropped.append(name)
    return sorted(dropped)
