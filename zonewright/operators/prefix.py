"""Ranks and running sums within groups of any size."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonewright.session import materialize


def cut_into_ranges(df: DataFrame, group: str, order: list, parts: int | None = None) -> DataFrame:
    """Rows with ``_group`` and ``_range``, cut into ranges of (group, order) with about as many rows each, and stored.

    Storing fixes the cut. A group of any size has as many ranges as its rows need.
    NULL as a group is one of its own: ``_group`` marks what is there, as NULL would not join.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    cut = df.withColumn("_group", marked).repartitionByRange(parts, "_group", *order)
    return materialize(cut.withColumn("_range", F.spark_partition_id()), "ranges")


def with_previous(df: DataFrame, group: str, order: str, tie: str, values: list[str], parts: int | None = None) -> DataFrame:
    """Adds ``previous``, a struct of what the row before in the group has in ``values``; NULL for the first one.

    Rows without an ``order`` come first; ``tie`` orders equal ones and should be unique in the group. A plain window would sort a whole group
    in one task. Here each range of rows looks back within itself, and only its first
    row of a group needs the last one of an earlier range: those, one per group and range, are carried over.
    """
    by = [F.asc_nulls_first(order), F.asc_nulls_first(tie)]
    ranged = cut_into_ranges(df, group, by, parts)
    value = F.struct(*values)
    place = F.struct(F.col(order), F.col(tie))
    last = ranged.groupBy("_group", "_range").agg(F.max_by(value, place).alias("_last"))
    # structs compare NULL as smallest, as the order does
    earlier = Window.partitionBy("_group").orderBy("_range")
    carried = last.select("_group", "_range", F.lag("_last").over(earlier).alias("_carried"))
    within = Window.partitionBy("_group", "_range").orderBy(*by)
    looked = ranged.withColumn("_before", F.lag(value).over(within))
    joined = looked.join(carried, ["_group", "_range"])
    return joined.select(*df.columns, F.coalesce("_before", "_carried").alias("previous"))


def running_totals(
    df: DataFrame,
    group: str,
    order: str,
    rank: str,
    sums: Mapping[str, str] | None = None,
    group_max: Mapping[str, str] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Rank rows of each ``group`` by the key ``order``, with running sums.

    ``sums`` and ``group_max`` map new column -> source column; the first gives
    inclusive running sums, the second the maximum over the whole group. A sum
    is NULL as long as no value has come, as in a plain window.

    A plain window would sort a whole group in one task. Here the rows are cut
    into ``parts`` ranges of (group, key) with about as many rows each, whatever
    the keys are, and stored, which fixes the cut. Each range is totalled per
    group (with map-side combine); the totals, at most one per group and range,
    are accumulated; and the rows are then windowed within their own range and
    shifted by what came before it. ``order`` should be unique. Rows without a
    key come first in their group, in any order, and spread over ranges as
    well. Rows without a group form one of their own.
    """
    sums, group_max = dict(sums or {}), dict(group_max or {})
    # of the row's values, so that a task that runs again deals its rows as before
    values = F.xxhash64(*(F.col(c) for c in df.columns))
    spread = F.when(F.col(order).isNull(), values).otherwise(0)
    ranged = cut_into_ranges(df.withColumn("_spread", spread), group, [F.asc_nulls_first(order), "_spread"], parts)

    totals = ranged.groupBy("_group", "_range").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(source).alias(f"_sum_{name}") for name, source in sums.items()],
        *[F.max(source).alias(f"_max_{name}") for name, source in group_max.items()],
    )
    whole_group = Window.partitionBy("_group")
    earlier = whole_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_group",
        "_range",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n"),
        *[F.sum(f"_sum_{name}").over(earlier).alias(f"_sum_{name}") for name in sums],
        *[F.max(f"_max_{name}").over(whole_group).alias(f"_max_{name}") for name in group_max],
    )

    within = Window.partitionBy("_group", "_range").orderBy(F.asc_nulls_first(order), "_spread")
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def running(name: str, source: str):
        before, own = F.col(f"_sum_{name}"), F.sum(source).over(so_far)
        return F.coalesce(before + own, before, own).alias(name)

    return ranged.join(offsets, ["_group", "_range"]).select(
        *df.columns,
        (F.col("_n") + F.row_number().over(within)).alias(rank),
        *[running(name, source) for name, source in sums.items()],
        *[F.col(f"_max_{name}").alias(name) for name in group_max],
    )
