"""Mixing documents to target shares of domains that each belongs to in part.

A classifier from labelled rows gives each document a posterior over the domains.
Rates r >= 0, how often a document is used, are fitted by least squares:

    sum over domains of (expected tokens - target)^2 / (2 total^2)
        + PULL * sum over documents of tokens / total * (r - 1)^2 / 2

by projected gradient descent with momentum, scaled by the tokens of each document and domain.
The unprojected rate of a document is 1 + posterior . c throughout, so a step needs
one aggregation of a number per domain, and the driver holds only c.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.session import materialize

#: Labelled rows that the classifier is trained on, about, where there are more; chosen by a hash of their key.
TRAINING_ROWS = 4000

#: Cells that words are hashed to.
CELLS = 1 << 12

#: How much rates are pulled to 1; gradient steps at most, and the change that ends them.
PULL, STEPS, SMALL = 1e-3, 60, 1e-5


def words(text: str) -> Column:
    """Words of a whole text, none for null."""
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), r"\s+"), "")


def _features(rows: DataFrame) -> DataFrame:
    counts = HashingTF(inputCol="__words", outputCol="__counts", numFeatures=CELLS).transform(rows)
    return Normalizer(inputCol="__counts", outputCol="features").transform(counts).drop("__counts")


def posteriors(docs: DataFrame, labelled: DataFrame, domains: list[str], key: str, text: str, keep: list[str]) -> DataFrame:
    """``record`` (a struct of ``keep``), ``n_tokens`` (words) and ``posterior`` (one share per domain), stored.

    ``labelled``: key and domain; rows of other domains are left out. The classifier sees distinct texts, about
    ``TRAINING_ROWS`` by hashes of the key and of the text, however many rows a key has. Without usable rows
    all domains are equally likely.
    """
    known = F.array(*map(F.lit, domains))
    marked = labelled.where(F.col("domain").isin(domains) & F.col(key).isNotNull())
    marked = marked.groupBy(F.col(key).alias("__key")).agg((F.array_position(known, F.min("domain")) - 1).cast("double").alias("label"))
    n = marked.count()
    marked = marked.where(F.pmod(F.xxhash64("__key"), F.lit(max(n, 1))) < TRAINING_ROWS)
    record = F.struct(*(F.col(f"`{c}`") for c in keep)).alias("record")
    rows = docs.select(record, F.col(key).alias("__key"), words(text).alias("__words"))
    # keys bounded by TRAINING_ROWS; equal texts of one label are one row, combined before they are shuffled
    training = docs.select(F.col(key).alias("__key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    training = training.join(F.broadcast(marked), "__key")
    training = training.groupBy(F.xxhash64("__text").alias("__hash"), "label").agg(F.min("__text").alias("__text"))
    training = materialize(training.select("__hash", words("__text").alias("__words"), "label"), "labelled")
    n_texts = training.count()
    if n_texts > TRAINING_ROWS:  # a key may have any number of texts
        training = materialize(training.where(F.pmod(F.xxhash64("__hash"), F.lit(n_texts)) < TRAINING_ROWS), "labelled")
    if training.isEmpty():
        equal = F.array_repeat(F.lit(1.0 / len(domains)), len(domains))
        soft = rows.withColumn("posterior", equal)
    else:
        model = LogisticRegression(family="multinomial", maxIter=30, regParam=1e-4).fit(_features(training).select("features", "label"))
        found = vector_to_array("probability")
        rest = [F.coalesce(F.get(found, F.lit(i)), F.lit(0.0)) for i in range(len(domains))]  # classes without a row
        soft = model.transform(_features(rows)).withColumn("posterior", F.array(*rest))
    return materialize(soft.select("record", F.size("__words").cast("long").alias("n_tokens"), "posterior"), "posteriors")


def _rate(c: list[float]) -> Column:
    along = sum((F.col("posterior")[i] * x for i, x in enumerate(c)), F.lit(1.0))
    return F.greatest(F.lit(0.0), along)


def fit(soft: DataFrame, targets: list[float]) -> list[float]:
    """The numbers c of the rates 1 + posterior . c, cut at 0, whose expected shares are next to ``targets``."""
    n = len(targets)
    mass = [F.col("posterior")[i] * F.col("n_tokens") for i in range(n)]
    total = soft.agg(F.sum("n_tokens")).first()[0] or 0
    if not total:
        return [0.0] * n

    def shares(c: list[float]) -> list[float]:
        return [x / total for x in soft.agg(*(F.sum(m * _rate(c)) for m in mass)).first()]

    c, ahead, speed = [0.0] * n, [0.0] * n, 1.0
    own = have = shares(c)
    for _ in range(STEPS):
        step = [(h - t + PULL * x) / (o + PULL) for h, t, x, o in zip(have, targets, ahead, own, strict=True)]
        new = [x - s for x, s in zip(ahead, step, strict=True)]
        if sum(o * s * (x - y) for o, s, x, y in zip(own, step, new, c, strict=True)) > 0:
            speed = 1.0  # the momentum has gone too far
        faster = (1 + math.sqrt(1 + 4 * speed * speed)) / 2
        ahead = [x + (speed - 1) / faster * (x - y) for x, y in zip(new, c, strict=True)]
        c, speed = new, faster
        if max(map(abs, step)) < SMALL:
            break
        have = shares(ahead)
    return c


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    weights: Mapping[str, float],
    keep: list[str],
    key: str = "doc_id",
    text: str = "text",
    seed: int = 0,
) -> DataFrame:
    """``record`` (a struct of ``keep``), ``n_tokens``, ``posterior``, ``domain``, ``rate`` and ``copies`` of each document.

    ``weights``: shares of tokens to reach, of the corpus' own total; the order of its keys is
    that of ``posterior``, and ``domain`` is the likeliest. ``copies`` is the rate rounded up or down by
    a seeded hash of the key, so that its mean is the rate. Null and empty texts have no
    tokens, and rate as their posterior gives. Rows are never merged: repeated rows get
    the same rate and copies. Other columns can't clash, as they stay in ``record``. An
    empty table gives an empty one.
    """
    domains, whole = list(weights), sum(weights.values())
    kept = keep if key in keep else [key, *keep]
    soft = posteriors(docs, labelled, domains, key, text, kept)
    c = fit(soft, [w / whole for w in weights.values()])
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(f"record.`{key}`")), F.lit(1 << 30)) / float(1 << 30)
    likeliest = F.array(*map(F.lit, domains))[(F.array_position("posterior", F.array_max("posterior")) - 1).cast("int")]
    rated = soft.withColumn("domain", likeliest).withColumn("rate", _rate(c))
    return rated.withColumn("copies", (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("int")).cast("int"))
