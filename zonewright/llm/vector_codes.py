"""Vector codes: each part of a vector becomes the number of its nearest codebook entry.

Distances are compared in the Walsh-Hadamard domain. The transform of a part that is
padded with zeros to D components, D a power of two, multiplies every squared distance
by D and keeps integers integers. Its coefficients are taken in sequency order, the
slowly changing ones first, and their squared differences added up. The sum only grows, so an
entry whose sum passes the whole distance of a good one is out, and few entries
are followed to the end. All of it is integer arithmetic, so ties are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from zonewright.llm.common import fields

#: Components are coded as integers: this times the component, rounded down.
SCALE = 256

#: Parts of a vector, entries of a part's codebook (256 at most, for a byte), and rounds of training.
N_PARTS, N_ENTRIES, N_ROUNDS = 16, 64, 2

#: Vectors whose distances to all entries a task holds at once.
BLOCK_ROWS = 1024


@dataclass(frozen=True)
class Codebooks:
    """Entries by part, number and place in the part; vectors have ``size`` components."""

    entries: np.ndarray
    size: int

    @property
    def limit(self) -> int:
        return component_limit(*self.entries.shape[::2])

    def sha256(self) -> str:
        """Of the decimal components of all entries, joined by commas; what only pads a vector isn't one."""
        width = self.entries.shape[2]
        shown = [part[:, : max(0, self.size - p * width)] for p, part in enumerate(self.entries)]
        return hashlib.sha256(",".join(str(x) for part in shown for x in part.ravel().tolist()).encode()).hexdigest()


def _padded(width: int) -> int:
    return 1 << max(0, width - 1).bit_length()


def component_limit(n_parts: int, width: int) -> int:
    """The largest integer component with which no sum of scaled squares over all parts passes 64 bits."""
    bits = 60 - 2 * (_padded(width).bit_length() - 1) - (n_parts - 1).bit_length()
    return 1 << bits // 2


def sequency_order(size: int) -> np.ndarray:
    """For each place in sequency order the row of the Hadamard matrix with that many changes of sign."""
    matrix = np.ones((1, 1), np.int8)
    while len(matrix) < size:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    return np.argsort((np.diff(matrix, axis=1) != 0).sum(1))


def walsh_hadamard(parts: np.ndarray) -> np.ndarray:
    """Integer transform along the last axis, which is padded with zeros to a power of two; sequency order."""
    *front, width = parts.shape
    size = _padded(width)
    x = np.zeros((*front, size), np.int64)
    x[..., :width] = parts
    half = 1
    while half < size:
        pairs = x.reshape(*front, size // (2 * half), 2, half)
        a, b = pairs[..., 0, :], pairs[..., 1, :]
        x = np.stack([a + b, a - b], axis=-2).reshape(*front, size)
        half *= 2
    return x[..., sequency_order(size)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each part's nearest entry, the lower one of equally near, and the squared distance times D.

    Both come transformed. The first half of the coefficients is added up for all entries. An entry then stays as long
    as its sum so far doesn't pass the whole distance of the entry that is nearest by then; one that ties with it stays.
    """
    size = parts.shape[1]
    largest = int(max(np.abs(parts).max(initial=0), np.abs(entries).max(initial=0)))
    if 4 * size * largest * largest < 1 << 31:  # sums of size squares of differences up to twice the largest
        parts, entries = parts.astype(np.int32), entries.astype(np.int32)
    columns = np.ascontiguousarray(entries.T)
    looked = max(1, size // 2)
    so_far = np.zeros((len(parts), len(entries)), parts.dtype)
    for i in range(looked):
        difference = parts[:, i, None] - columns[i]
        difference *= difference
        so_far += difference
    good = so_far.argmin(1)
    bound = ((parts - entries[good]) ** 2).sum(1, dtype=parts.dtype)
    row, entry = np.divmod(np.flatnonzero(so_far <= bound[:, None]), len(entries))
    so_far = so_far[row, entry]
    for i in range(looked, size):
        difference = parts[row, i] - columns[i][entry]
        so_far += difference * difference
        stays = so_far <= bound[row]
        row, entry, so_far = row[stays], entry[stays], so_far[stays]
    # what is left is ordered by row, then entry, and each row has the good entry at least
    begins = np.flatnonzero(np.diff(row, prepend=-1))
    least = np.minimum.reduceat(so_far, begins) if len(begins) else so_far
    at_least = np.flatnonzero(so_far == least[row])
    first = at_least[np.flatnonzero(np.diff(row[at_least], prepend=-1))]
    return entry[first], least.astype(np.int64)


def _integers(column: pa.Array, size: int, n_parts: int, width: int) -> np.ndarray:
    """Vectors of ``size`` components as integer parts, rounded down and padded with zeros."""
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, size)
    limit = component_limit(n_parts, width)
    parts = np.zeros((len(values), n_parts * width), np.int64)
    with np.errstate(over="ignore"):
        parts[:, :size] = np.clip(np.floor(values * SCALE), -limit, limit)
    return parts.reshape(-1, n_parts, width)


def _blocks(batches: Iterator[pa.RecordBatch], vector: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            block = batch.slice(at, BLOCK_ROWS)
            yield block, block.column(vector)


def usable(vector: str) -> Column:
    """Neither null nor empty, and no component null or non-finite."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, fine)


def _vectors(table: DataFrame, vector: str, *others: Column) -> DataFrame:
    doubles = F.col(f"`{vector}`").cast("array<double>").alias("vector")
    return table.select(doubles, *others).where(usable("vector"))


def _first_vectors(vectors: DataFrame, count: int) -> list[list[float]]:
    """The vectors with the smallest keys, the first in the order of their components where a key has several."""
    vectors = vectors.where("key IS NOT NULL")
    found = vectors.orderBy("key", "vector").limit(count).collect()
    keys = {row["key"] for row in found}
    if len(keys) < len(found):  # rows with one key: look for further keys, however many rows the first ones have
        keys = [row["key"] for row in vectors.select("key").distinct().orderBy("key").limit(count).collect()]
        held = vectors.where(F.col("key") <= F.lit(keys[-1]))
        found = held.groupBy("key").agg(F.min("vector").alias("vector")).orderBy("key").collect()
    return [row["vector"] for row in found]


def fit(
    table: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    n_parts: int = N_PARTS,
    n_entries: int = N_ENTRIES,
    rounds: int = N_ROUNDS,
) -> Codebooks:
    """Codebooks from all vectors.

    They start as the parts of the vectors with the ``n_entries`` smallest keys (fewer rows
    give fewer entries; rows without a key aren't among them, and of rows with one key the one
    whose components come first is). Each round assigns every part of every vector and
    replaces an entry by its parts' mean, rounded down; unused entries stay. Vectors that are null
    or empty or hold null or non-finite components take no part, nor do those of another length
    than the first. Where the length is no multiple of ``n_parts``, the last part is padded
    with zeros. Components beyond :func:`component_limit` count as the limit (262,144 after
    scaling back, for 64 components in 16 parts). Repeated rows count as often as they stand
    there. An empty table gives codebooks without entries.

    A round is one pass over the table. Each task adds up its own vectors, so what is
    shuffled and collected is bounded by the size of the codebooks. ``table`` is read once a
    round, so it should be stored, not computed.
    """
    if not 1 <= n_entries <= 256:
        raise ValueError("n_entries must be from 1 to 256, so that a number fits a byte")
    vectors = _vectors(table, vector, F.col(f"`{key}`").alias("key"))
    first = _first_vectors(vectors, n_entries)
    size = len(first[0]) if first else 0
    width = max(1, -(-size // n_parts))
    first = [v for v in first if len(v) == size]
    start = _integers(pa.array(first, pa.list_(pa.float64())), size, n_parts, width) if first else np.zeros((0, n_parts, width), np.int64)
    books = Codebooks(start.transpose(1, 0, 2).copy(), size)
    for _ in range(rounds if first else 0):
        books = _moved(vectors.where(F.size("vector") == size).select("vector"), books)
    return books


def _moved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """One round of training."""
    n_parts, n_entries, width = books.entries.shape
    totals = vectors.mapInArrow(partial(_totals, books), "part int, entry int, n long, sums array<long>")
    # a task's sums fit 64 bits, those of all tasks need not
    spread = totals.select("part", "entry", F.col("n").cast("decimal(38,0)").alias("n"), F.posexplode("sums").alias("at", "total"))
    added = spread.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    entries = books.entries.copy()
    for row in added.collect():  # as many as the codebooks have components, at most
        entries[row["part"], row["entry"], row["at"]] = int(row["total"]) // int(row["n"])
    return Codebooks(entries, books.size)


def _totals(books: Codebooks, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count and componentwise sum of the parts that each entry is nearest to, in this task."""
    n_parts, n_entries, width = books.entries.shape
    transformed = walsh_hadamard(books.entries)
    counts, sums = np.zeros((n_parts, n_entries), np.int64), np.zeros((n_parts, n_entries, width), np.int64)
    for _, column in _blocks(batches, 0):
        parts = _integers(column, books.size, n_parts, width)
        moved = walsh_hadamard(parts)
        for p in range(n_parts):
            entry, _ = nearest(moved[:, p], transformed[p])
            counts[p] += np.bincount(entry, minlength=n_entries)
            order = np.argsort(entry, kind="stable")
            begins = np.flatnonzero(np.diff(entry[order], prepend=-1))
            sums[p, entry[order][begins]] += np.add.reduceat(parts[order, p], begins, axis=0)
    part, entry = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(part, pa.int32()),
            pa.array(entry, pa.int32()),
            pa.array(counts[part, entry], pa.int64()),
            pa.array(sums[part, entry].tolist(), pa.list_(pa.int64())),
        ],
        names=["part", "entry", "n", "sums"],
    )


def encode(table: DataFrame, books: Codebooks, keep: list[str], vector: str = "embedding") -> DataFrame:
    """Columns ``keep``, ``code`` (a byte a part) and ``error`` (squared distance to the coded vector, in integers).

    Drops the vectors that :func:`usable` leaves out. One of another length than
    the codebooks' keeps its row, with null as code and error, as does every vector if there are no entries. One
    pass without a shuffle; other columns are not read.
    """
    new = [T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())]
    schema = T.StructType([*fields(table, *keep), *new])
    vectors = _vectors(table, vector, *(F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(keep)))
    fits = F.size("vector") == (books.size if books.entries.shape[1] else -1)
    vectors = vectors.select(F.when(fits, F.col("vector")).alias("vector"), *(f"__{i}" for i in range(len(keep))))
    return vectors.mapInArrow(partial(_codes, books, to_arrow_schema(schema)), schema)


def _codes(books: Codebooks, schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n_parts, _, width = books.entries.shape
    transformed = walsh_hadamard(books.entries)
    for block, column in _blocks(batches, 0):
        there = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
        moved = walsh_hadamard(_integers(column.drop_null(), max(1, books.size), n_parts, width))
        codes, error = np.zeros((len(there), n_parts), np.uint8), np.zeros(len(there), np.int64)
        for p in range(n_parts if len(there) else 0):
            codes[:, p], scaled = nearest(moved[:, p], transformed[p])
            error += scaled // transformed.shape[2]
        code, errors = np.full(block.num_rows, None, object), np.full(block.num_rows, None, object)
        code[there], errors[there] = [c.tobytes() for c in codes], error
        made = [pa.array(code, pa.binary()), pa.array(errors, pa.int64())]
        yield pa.RecordBatch.from_arrays([*block.columns[1:], *made], schema=schema)


def decode(encoded: DataFrame, books: Codebooks, keep: list[str], code: str = "code") -> DataFrame:
    """Columns ``keep`` and ``ints``, the integer vector that the code stands for; a null code gives null."""
    schema = T.StructType([*fields(encoded, *keep), T.StructField("ints", T.ArrayType(T.LongType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = np.arange(len(books.entries))
        for batch in batches:
            found = [c if c is None else books.entries[numbers, list(c)].ravel()[: books.size].tolist() for c in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, arrow[-1].type)], schema=arrow)

    return encoded.select(F.col(f"`{code}`").alias("__code"), *(f"`{c}`" for c in keep)).mapInArrow(run, schema)


def group_errors(encoded: DataFrame, group: str, error: str = "error", total: str = "group_error") -> DataFrame:
    """Adds the sum of ``error`` over the rows of the same group, null being one; beyond 64 bits, the largest long.

    Sums are combined before they are shuffled, and joined back: a group of any size is no single task's work.
    """
    added = F.sum(F.col(error).cast("decimal(38,0)"))
    largest = (1 << 63) - 1
    sums = encoded.groupBy(F.col(group).alias("__group")).agg(F.when(added > largest, largest).otherwise(added).cast("long").alias(total))
    return encoded.join(sums, F.col(group).eqNullSafe(F.col("__group"))).drop("__group")
