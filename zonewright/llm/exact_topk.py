"""Exact inner-product search with a vector-approximation file.

The file holds each component's cell, a byte. For a query, the cells bound a vector's
score from both sides. One scan finds the kth best lower bound, a second one the
vectors whose upper bound reaches it. Exact vectors are then read in the order of
their bounds: first the best few, then all whose bound reaches the kth exact
score of those, as nothing else can come in.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zonewright.session import materialize

#: Vectors and queries that meet in a task.
BLOCK_ROWS, QUERY_ROWS = 4096, 1024

#: Components are stored as integers: this times the component, rounded down.
SCALE = 1024

#: Exact vectors of a query's first read, as a multiple of k.
FIRST_READ = 4


def integers(vector: str) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def _usable(vector: str) -> Column:
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, fine)


def _matrix(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.array(column.combine_chunks().flatten().to_numpy(zero_copy_only=False), dtype).reshape(len(column), -1)


def _bounds(cells: pa.Table, queries: pa.Table, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores, queries by vectors.

    A cell c stands for the integers from c * 2^shift on, 2^shift of them.
    """
    q = _matrix(queries["ints"], np.float64)
    low = q @ (_matrix(cells["cells"], np.float64) * 2.0**shift).T
    rest = 2.0**shift - 1
    # products of this size are exact unless components are huge; then a little room keeps the bounds right
    room = np.abs(low) * 1e-12 if np.abs(low).max(initial=0) > 2**52 else 0.0
    lower = low + rest * np.minimum(q, 0).sum(1)[:, None] - room
    upper = low + rest * np.maximum(q, 0).sum(1)[:, None] + room
    return lower, upper


def _best_lower(shift: int, k: int, cells: pa.Table, queries: pa.Table) -> pa.Table:
    """The k best lower bounds of each query in the block, without the query's own vector."""
    if not len(cells) or not len(queries):
        return pa.table({"q": pa.array([], pa.int64()), "lower": pa.array([], pa.list_(pa.float64()))})
    lower, _ = _bounds(cells, queries, shift)
    lower[queries["own"].to_numpy()[:, None] == cells["v"].to_numpy()[None, :]] = -np.inf
    best = -np.partition(-lower, min(k, lower.shape[1]) - 1, axis=1)[:, :k]
    return pa.table({"q": queries["q"].combine_chunks(), "lower": pa.array(best.tolist(), pa.list_(pa.float64()))})


def _reaching(shift: int, cells: pa.Table, queries: pa.Table) -> pa.Table:
    """Pairs whose upper bound reaches the query's limit."""
    if not len(cells) or not len(queries):
        return pa.table({"q": pa.array([], pa.int64()), "v": pa.array([], pa.int64()), "upper": pa.array([], pa.float64())})
    _, upper = _bounds(cells, queries, shift)
    at_q, at_v = np.nonzero(upper >= queries["kth"].to_numpy()[:, None])
    return pa.table({"q": queries["q"].to_numpy()[at_q], "v": cells["v"].to_numpy()[at_v], "upper": upper[at_q, at_v]})


def top_k(table: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each row of ``queries`` the k rows of ``table`` with the highest scores: query_id, rank, vec_id, score.

    Score: inner product of the integer vectors. Ties go to the smaller key. A row isn't
    compared with rows of its own key, nor with vectors of another length. Null and empty
    vectors, and those with null or non-finite components, take no part, nor do rows without a
    key. Repeated rows count once. Equal vectors are one vector with its k + 1 smallest
    keys, which are all that a result can show, so a vector that many rows have is
    searched once. Fewer than k rows give fewer results, an empty table none.
    """
    rows = table.where(_usable(vector) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), integers(vector).alias("ints"))
    by_vector = Window.partitionBy("ints").orderBy("id")
    few = rows.dropDuplicates(["id", "ints"]).withColumn("n", F.row_number().over(by_vector)).where(F.col("n") <= k + 1)
    distinct = few.groupBy("ints").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    vectors = materialize(distinct.withColumn("v", F.monotonically_increasing_id()), "vectors")
    largest = vectors.agg(F.max(F.array_max(F.transform("ints", F.abs))), F.count(F.lit(1))).first()
    shift = max(0, int(largest[0] or 0).bit_length() - 7)
    n_blocks = max(1, math.ceil(largest[1] / BLOCK_ROWS))
    block = F.pmod(F.xxhash64("v"), F.lit(n_blocks)).cast("int").alias("block")
    cells = F.transform("ints", lambda x: F.shiftright(x, shift).cast("byte")).alias("cells")
    file = materialize(vectors.select("v", block, F.size("ints").alias("dim"), cells), "approximations")

    asked = queries.where(_usable(vector) & F.col(key).isNotNull())
    asked = asked.select(F.col(key).cast("long").alias("query_id"), integers(vector).alias("ints")).distinct()
    # numbers are stored before they are joined: a task that ran again could number its rows otherwise
    asked = materialize(asked.withColumn("q", F.monotonically_increasing_id()), "numbered")
    asked = asked.join(vectors.select("ints", F.col("v").alias("own")), "ints", "left")
    asked = materialize(asked.withColumn("own", F.coalesce("own", F.lit(-1))), "queries")
    n_parts = max(1, math.ceil(asked.count() / QUERY_ROWS))
    part = F.pmod(F.xxhash64("q"), F.lit(n_parts)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    meet = ["dim", "block", "part"]
    filed = file.withColumn("part", every(n_parts)).groupBy(meet)
    spread = asked.select("q", "own", "ints", F.size("ints").alias("dim"), part.alias("part"), every(n_blocks).alias("block"))

    lowers = filed.cogroup(spread.groupBy(meet)).applyInArrow(partial(_best_lower, shift, k), "q long, lower array<double>")
    lowers = lowers.select("q", F.explode("lower").alias("lower"))
    nth = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("lower")))
    kth = lowers.withColumn("nth", nth).where(F.col("nth") <= k).groupBy("q").agg(
        F.when(F.count(F.lit(1)) == k, F.min("lower")).otherwise(float("-inf")).alias("kth")
    )
    limited = spread.join(kth, "q", "left").withColumn("kth", F.coalesce("kth", F.lit(float("-inf"))))
    reaching = filed.cogroup(limited.groupBy(meet)).applyInArrow(partial(_reaching, shift), "q long, v long, upper double")
    reaching = materialize(reaching, "candidates")

    product = F.aggregate(F.zip_with("ints", "asked", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
    wanted = asked.select("q", "query_id", "own", F.col("ints").alias("asked"))

    def read(candidates: DataFrame) -> DataFrame:
        exact = candidates.join(vectors, "v").join(wanted, "q")
        return exact.select("q", "query_id", "v", "own", "ids", product.alias("score"))

    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")

    def ranked(scored: DataFrame) -> DataFrame:
        single = scored.select("q", "query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
        return single.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    # the ranks end at a limit, so each task keeps so many candidates of a query before they meet
    by_bound = Window.partitionBy("q").orderBy(F.desc("upper"), "v")
    first = reaching.withColumn("nth", F.row_number().over(by_bound)).where(F.col("nth") <= FIRST_READ * k)
    certain = ranked(read(first)).groupBy("q").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("kth"))
    # whatever is among the best reaches their kth score, what was read first as well
    later = reaching.join(certain, "q", "left").where(F.col("kth").isNull() | (F.col("upper") >= F.col("kth"))).select("q", "v")
    return ranked(read(later)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
