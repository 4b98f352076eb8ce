"""A two-pass external shuffle of records into shards.

Pass one scatters the records into buckets that fit in a task's memory, by a seeded
hash. Pass two shuffles each bucket by Fisher-Yates and writes it. The written
buckets, one after another, are a random order of all records; a record's place in
it decides its shard and slot, so shards differ by one record at most.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from zonewright.session import materialize

#: Bytes of a bucket, about. A task holds it two or three times.
BUCKET_BYTES = 64 << 20

#: Buckets up to which their offsets (16 bytes each) are broadcast.
BROADCAST_BUCKETS = 500_000


def _size(df: DataFrame) -> F.Column:
    wide = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)).cast("long") for c in wide]
    return sum(sizes, F.lit(8 * len(df.columns)).cast("long"))


def shuffle(df: DataFrame, n_shards: int, seed: int = 0, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Each row as ``record``, a struct of all its columns, with ``shard`` and ``slot`` (gapless from 0).

    The scatter hashes the seed and the row's place in its input partition, not its
    values, so copies and rows with one key spread evenly, and nulls need no rule. The
    same files read in the same splits give the same result; an input that is
    computed should be stored first, since a task that ran again might order its rows otherwise. Columns may have any names, as
    they stay inside ``record``. An empty table gives an empty one. Buckets are
    written to the shared folder, so a lost executor can't change a row's place.
    """
    spark = df.sparkSession
    total = df.agg(F.sum(_size(df))).first()[0] or 0
    n_buckets = max(math.ceil(total / bucket_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    scattered = df.select(
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("record"),
        F.xxhash64(F.lit(seed), F.monotonically_increasing_id()).alias("draw"),
    ).select("record", "draw", F.pmod(F.xxhash64(F.lit(seed + 1), "draw"), F.lit(n_buckets)).cast("int").alias("bucket"))
    schema = T.StructType([*scattered.select("record", "bucket").schema, T.StructField("place", T.LongType())])

    def fisher_yates(key: tuple, rows: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        start = np.argsort(rows["draw"].to_numpy(), kind="stable")  # rows arrive in any order
        order = start[np.random.default_rng([seed, bucket]).permutation(len(start))]
        rows = rows.select(["record", "bucket"]).take(pa.array(order))
        return rows.append_column("place", pa.array(np.arange(len(order), dtype=np.int64)))

    buckets = materialize(scattered.groupBy("bucket").applyInArrow(fisher_yates, schema), "buckets")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    offsets = offsets.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    if n_buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    place = F.col("offset") + F.col("place")
    return buckets.join(offsets, "bucket").select(
        "record", F.pmod(place, F.lit(n_shards)).cast("int").alias("shard"), F.floor(place / n_shards).cast("long").alias("slot")
    )


def write_shards(shuffled: DataFrame, path: str) -> None:
    """One folder per shard, its files in the order of the slots within."""
    shuffled.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
