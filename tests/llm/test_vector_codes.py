"""Vector codes against plain distances and means over all entries."""

import hashlib
import math
import random

import numpy as np
import pytest

from tests.conftest import SMALL
from zonewright.llm import queries, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, part int, entry int, key long, vector int"


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame([(i, x, lab, "c", 1, 2, 3, 4, 5) for i, x, lab in rows], SCHEMA)


def floors(x):
    return [math.floor(256 * c) for c in x]


def fine(x):
    return x and all(c is not None and math.isfinite(c) for c in x)


def near(part, book):
    return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(book))


def brute(rows, n_parts=16, n_entries=64, rounds=2):
    """vec_id, code, error of each kept row, and the codebooks; all vectors have one length."""
    kept = sorted((i, floors(x)) for i, x, _ in rows if fine(x) and i is not None)
    without = [(i, floors(x)) for i, x, _ in rows if fine(x) and i is None]
    first = {}
    for i, x in kept:
        first.setdefault(i, x)
    width = -(-len(next(iter(first.values()))) // n_parts)
    cut = lambda x: [(x + [0] * (n_parts * width))[p * width : (p + 1) * width] for p in range(n_parts)]
    starts = [cut(first[i]) for i in sorted(first)[:n_entries]]
    books = [[s[p] for s in starts] for p in range(n_parts)]
    parts = [cut(x) for _, x in kept + without]
    for _ in range(rounds):
        for p in range(n_parts):
            held = [[] for _ in books[p]]
            for x in parts:
                held[near(x[p], books[p])[1]].append(x[p])
            books[p] = [[sum(c) // len(h) for c in zip(*h, strict=True)] if h else e for e, h in zip(books[p], held, strict=True)]
    coded = []
    for (i, _), x in zip(kept + without, parts, strict=True):
        best = [near(x[p], books[p]) for p in range(n_parts)]
        coded.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
    return coded, books


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))


def coded(df, books):
    return order((r.vec_id, r.code.hex(), r.error) for r in vector_codes.encode(df, books, ["vec_id"]).collect())


def floats(rng, n, size):
    return [[rng.randint(-512, 512) / 512 for _ in range(size)] for _ in range(n)]


def test_transform_keeps_distances():
    rng = np.random.default_rng(1)
    for width in (1, 2, 3, 4, 7, 16):
        x, y = rng.integers(-1000, 1000, (2, 50, width))
        size = vector_codes.walsh_hadamard(x).shape[-1]
        assert size >= width and size & (size - 1) == 0
        scaled = ((vector_codes.walsh_hadamard(x) - vector_codes.walsh_hadamard(y)) ** 2).sum(1)
        assert (scaled == size * ((x - y) ** 2).sum(1)).all()


def test_sequency_order_counts_changes_of_sign():
    rows = vector_codes.walsh_hadamard(np.eye(8, dtype=np.int64)).T
    assert [(np.diff(r) != 0).sum() for r in rows] == list(range(8))


def test_nearest_takes_the_lower_of_equal_entries():
    rng = np.random.default_rng(2)
    for width in (1, 3, 4, 8):
        parts, entries = rng.integers(-3, 4, (400, width)), rng.integers(-3, 4, (20, width))
        number, scaled = vector_codes.nearest(vector_codes.walsh_hadamard(parts), vector_codes.walsh_hadamard(entries))
        plain = ((parts[:, None] - entries[None]) ** 2).sum(2)
        assert (number == plain.argmin(1)).all()
        assert (scaled == plain.min(1) * vector_codes._padded(width)).all()


@pytest.mark.parametrize("size", [64, 16, 50])
def test_against_brute_force(vectors, size):
    rng = random.Random(size)
    rows = [(i * 3 - 50, x, i % 4 or None) for i, x in enumerate(floats(rng, 200, size))]
    rows += [(900 + i, rows[5][1], 1) for i in range(40)]  # copies
    rows += [(-50, rows[9][1], 1), rows[3], rows[3]]  # keys that repeat
    rows += [(2000, None, 1), (2001, [], 1), (2002, [None] * size, 1), (2003, [float("nan")] * size, 2), (2004, [float("-inf")] * size, 2)]
    rows += [(None, rows[7][1], None)]
    df = vectors(rows)
    expected, plain = brute(rows)
    books = vector_codes.fit(df)
    width = books.entries.shape[2]
    assert books.entries.tolist() == plain
    assert coded(df, books) == order(expected)
    flat = ",".join(str(c) for p in range(16) for e in plain[p] for c in e[: max(0, min(width, size - p * width))])
    assert books.sha256() == hashlib.sha256(flat.encode()).hexdigest()


def test_decode_gives_the_entries(vectors):
    rng = random.Random(3)
    rows = [(i, x, 1) for i, x in enumerate(floats(rng, 100, 50))]
    df = vectors(rows)
    books = vector_codes.fit(df)
    back = vector_codes.decode(vector_codes.encode(df, books, ["vec_id"]), books, ["vec_id", "error"]).collect()
    given = {i: floors(x) for i, x, _ in rows}
    for r in back:
        assert sum((a - b) ** 2 for a, b in zip(r.ints, given[r.vec_id], strict=True)) == r.error


def test_few_rows_other_lengths_and_none(vectors):
    df = vectors([(1, [0.5] * 16, 1), (2, [0.25] * 16, 1), (3, [0.5] * 8, 1)])
    books = vector_codes.fit(df)
    assert books.entries.shape == (16, 2, 1)
    assert coded(df.where("vec_id < 3"), books) == [(1, "00" * 16, 0), (2, "01" * 16, 0)]
    other = vector_codes.encode(df, books, ["vec_id"]).where("vec_id = 3").first()
    assert other.code is None and other.error is None
    none = vector_codes.fit(vectors([]))
    assert none.entries.shape[1] == 0 and none.sha256() == hashlib.sha256(b"").hexdigest()
    assert vector_codes.encode(vectors([]), none, ["vec_id"]).collect() == []
    assert [r.code for r in vector_codes.encode(df, none, ["vec_id"]).collect()] == [None] * 3


def test_huge_components_count_as_the_limit(vectors):
    limit = vector_codes.component_limit(16, 4) // 256
    assert limit == 262144
    huge, most = [3e38] * 32 + [-3e38] * 32, [float(limit)] * 32 + [-float(limit)] * 32
    rows = [(1, huge, 1), (2, [0.0] * 64, 1), (3, most, 1), (4, [-c for c in huge], 1)]
    df = vectors(rows)
    out = {r.vec_id: (r.code, r.error) for r in vector_codes.encode(df, vector_codes.fit(df), ["vec_id"]).collect()}
    assert out[1] == out[3] and all(e >= 0 for _, e in out.values())


def test_group_errors(spark):
    rows = [(1, 1, 5), (2, 1, 7), (3, None, 2), (4, None, 4), (5, 2, None), (6, 3, (1 << 63) - 1), (7, 3, 9)]
    df = vector_codes.group_errors(spark.createDataFrame(rows, "vec_id long, label int, error long"), "label")
    assert sorted((r.vec_id, r.group_error) for r in df.collect() if r.vec_id != 5) == [(1, 12), (2, 12), (3, 6), (4, 6), (6, (1 << 63) - 1), (7, (1 << 63) - 1)]
    assert df.where("vec_id = 5").first().group_error is None


def test_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    expected, _ = brute(rows)
    out = queries.op12_vector_codes(spark, SMALL).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in out) == sorted(expected)
    by_label, label = {}, {i: lab for i, _, lab in rows}
    for i, _, error in expected:
        by_label[label[i]] = by_label.get(label[i], 0) + error
    assert all(r.label_error == by_label[label[r.vec_id]] for r in out)
