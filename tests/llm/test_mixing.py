"""Posteriors on held-out rows, and the fit against a plain solver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import MEDIUM
from zonewright.llm import mixing, queries

WEIGHTS = {"en": 0.5, "fr": 0.3, "xx": 0.2}


def solved(posterior, tokens, targets):
    """Projected gradient over all rates at once, to the end."""
    total, rate = tokens.sum(), np.ones(len(tokens))
    for _ in range(200_000):
        error = posterior.T @ (tokens * rate) / total - targets
        new = np.maximum(0, rate - 0.5 * (posterior @ error + mixing.PULL * (rate - 1)))
        if np.abs(new - rate).max() < 1e-10:
            break
        rate = new
    return rate


def test_rates_equal_a_plain_solver(spark):
    rng = np.random.default_rng(1)
    posterior = rng.dirichlet([0.2, 0.3, 0.5], 60)
    tokens = rng.integers(0, 500, 60).astype(float)
    targets = np.array([0.7, 0.28, 0.02])
    soft = spark.createDataFrame([(p.tolist(), int(t)) for p, t in zip(posterior, tokens, strict=True)], "posterior array<double>, n_tokens long")
    c = mixing.fit(soft, targets.tolist())
    rate = np.maximum(0, 1 + posterior @ c)
    expected = solved(posterior, tokens, targets)
    assert np.abs(rate - expected).max() < 0.02
    share = lambda r: posterior.T @ (tokens * r) / tokens.sum()
    assert np.abs(share(rate) - share(expected)).max() < 1e-3


def test_mixes_a_hot_domain_with_nulls_and_clashing_columns(spark, docs):
    rows = [(i, "the house and the garden " * 5, "en") for i in range(80)] + [(100 + i, "la maison et le jardin " * 5, "fr") for i in range(20)]
    rows += [(200, None, None), (201, "", "en"), (None, "the house", "en"), (3, "the house and the garden " * 5, "en"), (202, "the " * 50_000, "en")]
    df = docs(rows).where("doc_id IS NULL OR doc_id <> 202")
    labelled = df.select("doc_id", F.col("lang").alias("domain"))
    out = mixing.mix(df, labelled, WEIGHTS, df.columns).collect()
    assert len(out) == len(rows) - 1
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) and len(r.posterior) == 3 for r in out)
    assert {r.rate for r in out if r.record.doc_id == 3} == {next(r.rate for r in out if r.record.doc_id == 4)}
    total = sum(r.n_tokens for r in out)
    reached = {d: sum(r.rate * r.n_tokens * r.posterior[i] for r in out) / total for i, d in enumerate(WEIGHTS)}
    assert abs(reached["en"] - 0.5) < 0.02 and abs(reached["fr"] - 0.3) < 0.02
    assert {r.n_tokens for r in out if not r.record.text} == {0}
    assert mixing.mix(docs(rows), labelled, WEIGHTS, ["doc_id"]).count() == len(rows)


@pytest.mark.parametrize("n", [0, 3])
def test_without_labels_or_rows(docs, n):
    df = docs([(i, "some words", "en") for i in range(n)])
    none = df.select("doc_id", F.col("lang").alias("domain")).limit(0)
    out = mixing.mix(df, none, WEIGHTS, ["doc_id"]).collect()
    assert len(out) == n and all(r.posterior == pytest.approx([1 / 3] * 3) for r in out)


def test_held_out_accuracy(spark):
    documents = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    labelled = queries.labelled_languages(spark, MEDIUM).where(~held_out)
    mixed = mixing.mix(documents, labelled, queries.LANGUAGE_WEIGHTS, ["doc_id", "lang"]).select("record.*", "domain")
    right = mixed.where(held_out).agg(F.avg((F.col("lang") == F.col("domain")).cast("int"))).first()[0]
    assert right >= 0.9


def test_query_reaches_its_targets(spark):
    rows = queries.op6_mixing(spark, MEDIUM).collect()
    assert len(rows) == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    total = sum(r.n_tokens for r in rows)
    for i, weight in enumerate(queries.LANGUAGE_WEIGHTS.values()):
        assert abs(sum(r.rate * r.n_tokens * r.posterior[i] for r in rows) / total - weight) < 0.01


def test_no_python_in_the_plan(spark):
    plan = queries.op6_mixing(spark, MEDIUM)._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan
