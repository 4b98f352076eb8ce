"""Searches against scores of all pairs."""

import math
import random

import pytest

from tests.conftest import SMALL
from zonewright.llm import exact_topk, queries

SCHEMA = "vec_id long, embedding array<float>, label int, q long, v long, score string"


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame([(i, x, 0, 1, 1, "s") for i, x in rows], SCHEMA)


def brute(rows, asked, k):
    fine = {(i, tuple(math.floor(1024 * c) for c in x)) for i, x in rows if i is not None and x and all(c is not None and math.isfinite(c) for c in x)}
    out = []
    for i, q in fine:
        if asked(i):
            scored = sorted((-sum(a * b for a, b in zip(q, x, strict=True)), j) for j, x in fine if j != i and len(x) == len(q))
            out += [(i, n, j, -s) for n, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(df, asked, k):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in exact_topk.top_k(df, df.where(asked), k).collect())


def floats(rng, n, size=8):
    # multiples of 2^-12, which a float holds exactly
    return [[rng.randint(-4096, 4096) / 4096 for _ in range(size)] for _ in range(n)]


def test_ties_copies_and_bad_rows(vectors):
    rng = random.Random(2)
    rows = list(enumerate(floats(rng, 150)))
    common = floats(rng, 1)[0]
    rows += [(i, common) for i in range(1000, 1100)]  # more copies than results
    rows += [(5, rows[5][1]), (2000, None), (2010, []), (2020, [None] * 8), (2030, [float("nan")] * 8), (2040, [float("inf")] * 8)]
    rows += [(None, common), (2050, [0.0] * 8), (2060, [0.5] * 3), (2070, [0.25] * 3)]
    df = vectors(rows)
    assert found(df, "vec_id % 10 = 0", 7) == brute(rows, lambda i: i % 10 == 0, 7)


def test_small_blocks_and_a_short_first_read(vectors, monkeypatch):
    monkeypatch.setattr(exact_topk, "BLOCK_ROWS", 37)
    monkeypatch.setattr(exact_topk, "QUERY_ROWS", 11)
    monkeypatch.setattr(exact_topk, "FIRST_READ", 1)
    rows = list(enumerate(floats(random.Random(3), 300, 3)))
    assert found(vectors(rows), "vec_id % 5 = 0", 4) == brute(rows, lambda i: i % 5 == 0, 4)


def test_fewer_rows_than_results_and_none(vectors):
    rows = [(1, [1.0, 0.5]), (2, [0.5, 0.5]), (3, [-1.0, 2.0])]
    assert found(vectors(rows), "vec_id = 1", 10) == brute(rows, lambda i: i == 1, 10)
    assert found(vectors([]), "vec_id = 1", 10) == []
    assert found(vectors([(1, [1.0])]), "vec_id = 1", 10) == []


def test_large_components(vectors):
    rng = random.Random(4)
    rows = [(i, [c * 2.0**13 for c in x]) for i, x in enumerate(floats(rng, 80))]
    assert found(vectors(rows), "vec_id < 9", 5) == brute(rows, lambda i: i < 9, 5)


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    out = queries.op8_exact_topk(spark, SMALL).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in out) == brute(rows, lambda i: i % 100 == 0, 10)


def test_a_crowd_next_to_one_query(vectors, monkeypatch):
    """A third of all vectors nearly reach each other's scores; only so many are ranked as the first read takes."""
    monkeypatch.setattr(exact_topk, "FIRST_READ", 2)
    rng = random.Random(8)
    base = floats(rng, 1)[0]
    near = [[c + rng.randint(-3, 3) / 4096 for c in base] for _ in range(300)]
    rows = list(enumerate(near)) + [(1000 + i, x) for i, x in enumerate(floats(rng, 600))]
    assert found(vectors(rows), "vec_id % 50 = 0", 6) == brute(rows, lambda i: i % 50 == 0, 6)
