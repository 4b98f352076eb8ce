"""Folding, exceptions, learned entries, and held-out accuracy on labelled rows."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import MEDIUM
from zonewright.llm import queries, toxicity
from zonewright.llm.toxicity import Lexicon, fold, hits, score

INSULTS = Lexicon((("idiot", 5.0), ("trash", 5.0), ("stupid ", 5.0)))


@pytest.mark.parametrize(
    "text, folded",
    [
        ("You 1D10T!", " you idiot "),
        ("ѕtuріd", " stupid "),  # Cyrillic letters
        ("$tup1d tr@sh", " stupid trash "),
        ("ídïöt id\u200biot", " idiot idiot "),
        ("2020 and 100", " 2020 and 100 "),
        ("", "  "),
        ("ｉｄｉｏｔ", " idiot "),
    ],
)
def test_fold(text, folded):
    assert fold(text) == folded


def test_exceptions_and_word_borders():
    assert hits("the trash can is full", INSULTS)[0] == 0
    assert hits("the trash can is full of trash", INSULTS)[0] == 5
    assert hits("idiotic", INSULTS)[0] == 5 and hits("xidiot", INSULTS)[0] == 0
    assert hits("stupid", INSULTS)[0] == 5 and hits("stupidity", INSULTS)[0] == 0


def test_scores_fall_with_length_and_stay_within_0_and_1():
    scores = [score("word " * n + "idiot", INSULTS) for n in (0, 10, 1000, 20_000)]
    assert all(1 >= a > b > 0 for a, b in zip(scores, scores[1:], strict=False))
    assert scores[-1] >= toxicity.THRESHOLD
    assert score("idiot " * 100_000, INSULTS) <= 1
    assert score("word " * 100_000, INSULTS) == 0


def labelled(spark, docs, toxic_rows=60, other_rows=300):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 6)))
    prose = lambda: " ".join(word() for _ in range(30))
    rows = [(i, f"{prose()} zorblu{word()} {prose()}") for i in range(toxic_rows)]
    rows += [(1000 + i, prose()) for i in range(other_rows)]
    labels = spark.createDataFrame([(i, 5, int(i < 1000)) for i, _ in rows] + [(None, 5, 1), (7, 5, None)], "doc_id long, quality int, toxic int")
    return docs(rows), labels


def test_learns_the_beginning_that_toxic_rows_share(spark, docs):
    lexicon = toxicity.learn(*labelled(spark, docs))
    learned = [w for w, _ in lexicon.weights if w.strip() == w and w not in toxicity.INSULTS]
    assert learned == ["zorblu"]
    assert score("some zorbluxyz here", lexicon) > 0.5 and score("nothing to see", lexicon) == 0


def test_without_usable_labels_the_list_is_the_lexicon(spark, docs):
    df, labels = labelled(spark, docs, 20, 0)
    for none in (labels, labels.limit(0)):
        assert {w.strip() for w, _ in toxicity.learn(df, none).weights} >= set(toxicity.INSULTS)
    assert toxicity.learn(docs([]), labels).weights


def test_null_empty_repeated_and_clashing(docs):
    df = docs([(1, None), (2, ""), (3, "idiot"), (3, "idiot"), (None, "fine")]).withColumnRenamed("score", "predicted")
    scores = sorted((r.doc_id or 0, round(r.score, 3)) for r in toxicity.score_texts(df, INSULTS, ["doc_id"]).collect())
    one = round(score("idiot", INSULTS), 3)
    assert scores == [(0, 0.0), (1, 0.0), (2, 0.0), (3, one), (3, one)]
    rows = toxicity.score_rows(docs([(1, "idiot")]), INSULTS)
    assert rows.select("record.*").columns == docs([]).columns
    assert toxicity.score_texts(docs([]), INSULTS, ["doc_id"]).count() == 0


def test_held_out_rows(spark):
    scored = queries.op10_toxicity(spark, MEDIUM)
    marked = scored.join(spark.read.parquet(f"{MEDIUM}/labels.parquet"), "doc_id").where("held_out")
    counts = {(r.toxic, r.predicted): r.n for r in marked.groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()}
    clean, flagged = counts.get((0, 0), 0), counts.get((0, 1), 0)
    assert flagged <= 0.01 * (clean + flagged)
    assert counts.get((1, 1), 0) >= 0.6 * (counts.get((1, 1), 0) + counts.get((1, 0), 0))
    assert scored.where("score < 0 OR score > 1 OR score IS NULL OR predicted <> int(score >= 0.3)").count() == 0


def test_training_rows_are_bounded_whatever_a_key_has(spark, docs, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAINING_ROWS", 400)
    sizes = []
    keep = toxicity.materialize
    monkeypatch.setattr(toxicity, "materialize", lambda df, label: sizes.append((stored := keep(df, label)).count()) or stored)
    for crowded in ([(5, f"text {i} of one key") for i in range(6000)], [(5, "copies of one text")] * 6000):
        sizes.clear()
        rows = crowded + [(i, f"text {i} of many keys") for i in range(10, 3000)]
        labels = spark.createDataFrame([(i, int(i % 2)) for i in range(3000)], "doc_id long, toxic int")
        toxicity.learn(docs(rows), labels)
        assert sizes[-1] <= 1.25 * 400  # 400 by a hash, give or take


def test_copies_of_one_text_teach_nothing(spark, docs):
    rng = random.Random(3)
    prose = lambda n: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(3, 6))) for _ in range(n))
    copied = prose(150) + " shredword " + prose(150)
    toxic = [f"{copied} {prose(3)}" for _ in range(30)] + [f"{prose(20)} zorblu {prose(20)}" for _ in range(40)]
    rows = list(enumerate(toxic)) + [(1000 + i, prose(40)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in rows], "doc_id long, toxic int")
    learned = {w for w, _ in toxicity.learn(docs(rows), labels).weights if w.strip() == w}
    assert "zorblu" in learned and not any(w.startswith("shre") for w in learned)
