"""Cuts and outputs against a plain split of the text."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from zonewright.llm import fill_in_middle as fim
from zonewright.llm import queries

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, seed=42, percent=50, spm=80):
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted(x % (len(tokens) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return len(tokens), "plain", None, None, text
    prefix, middle, suffix = ("".join(tokens[a:b]) for a, b in ((0, low), (low, high), (high, None)))
    form = "spm" if h[3] % 100 < spm else "psm"
    output = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(tokens), form, len(prefix), len(prefix) + len(middle), output


TEXTS = [
    "",
    None,
    " ",
    " \t\n\r\x0b\x0c",
    "one",
    "  one two\tthree\n\n",
    "café 字字字 \U0001f600 naïve word  x",
    "holds <P> a mark",
    "<M>",
    "almost <P a mark <S <M > > < <",
    "< < < << <S<S <P <<P",
    "x" * 3000 + " " + "y" * 70000 + " z",
    "nul \x00 byte\x1c\x85 \x7f",
]


@pytest.mark.parametrize("kind", ["words", "bursts", "tiny"])
def test_segments_are_bounded_and_exact(kind, monkeypatch):
    rng = np.random.default_rng(3)
    steps = {
        "words": rng.integers(1, 12, 50_000),
        "bursts": np.where(rng.random(20_000) < 0.01, 5000, rng.integers(1, 4, 20_000)),
        "tiny": rng.integers(1, 3, 7),
    }[kind]
    offsets = np.concatenate([[0], np.cumsum(steps)])
    for error in (3, fim.ERROR):
        segments, residuals = fim.fit_segments(offsets, error)
        assert np.abs(residuals).max() <= error + 2
        ranks = np.arange(len(offsets))
        first, base, slope = segments[np.searchsorted(segments[:, 0], ranks, side="right") - 1].T
        assert (base + ((ranks - first) * slope >> fim.SLOPE_BITS) + residuals == offsets).all()
    if kind == "words":
        assert len(segments) < len(offsets) / 200


def test_segments_end_at_the_slopes_bits(monkeypatch):
    monkeypatch.setattr(fim, "SLOPE_BITS", 6)
    offsets = np.arange(0, 3000, 3)
    segments, residuals = fim.fit_segments(offsets)
    assert len(segments) == -(-len(offsets) // 64) and np.abs(residuals).max() <= fim.ERROR + 2


def test_boundaries():
    rng = random.Random(4)
    texts = [t or "" for t in TEXTS] + ["".join(rng.choices("aé\U0001f600 \t\n\x0b\x1c", k=rng.randint(0, 30))) for _ in range(500)]
    for text in texts:
        ends = np.cumsum([0, *map(len, TOKEN.findall(text))]).tolist()
        assert fim.boundaries(text.encode()).tolist() == ends


def test_every_rank_is_found(spark, docs):
    words = " ".join("w" * (i % 17 + 1) + ("字" if i % 5 else "") for i in range(3000))
    indexed = fim.with_index(docs([(1, words)]))
    ranks = indexed.withColumn("rank", F.explode(F.sequence(F.lit(0).cast("long"), F.col("index.n"))))
    out = ranks.select("rank", fim.offset_of("index", F.col("rank")).alias("offset")).orderBy("rank").collect()
    assert [r.offset for r in out] == fim.boundaries(words.encode()).tolist()


def rows_of(df):
    return df.select("record.doc_id", "index.n", "form", "cuts.start", "cuts.end", "output", fim.restored("output", "form").alias("text")).collect()


@pytest.mark.parametrize("seed,percent,spm", [(42, 50, 80), (7, 100, 50), (8, 100, 0), (9, 0, 80)])
def test_against_plain_splits(docs, seed, percent, spm):
    rng = random.Random(seed)
    made = ["".join(rng.choices("abé \n<PSM>", k=rng.randint(1, 40))) for _ in range(150)]
    rows = list(enumerate(TEXTS + made)) + [(None, "text without a key"), (5, "  one two\tthree\n\n")]
    out = rows_of(fim.rearrange(fim.with_index(docs(rows)), seed=seed, percent=percent, suffix_first_percent=spm))
    expected = [(i, *brute(i, t, seed, percent, spm), t or "") for i, t in rows]
    assert sorted(map(repr, map(tuple, out))) == sorted(map(repr, expected))


def test_long_texts(docs):
    rng = random.Random(6)
    rows = [(i, " ".join("x" * rng.randint(1, 30) for _ in range(60_000))) for i in range(6)]
    out = rows_of(fim.rearrange(fim.with_index(docs(rows)), percent=100))
    assert sorted(map(tuple, out)) == sorted((i, *brute(i, t, percent=100), t) for i, t in rows)


def test_empty_table(docs):
    assert rows_of(fim.rearrange(fim.with_index(docs([])))) == []


def test_marks_that_overlap_are_refused(docs):
    for marks in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("aba", "<S>", "<M>"), ("xy", "yz", "<M>"), ("<P", "<P>", "<M>")):
        with pytest.raises(ValueError):
            fim.rearrange(fim.with_index(docs([])), marks=marks)


def test_own_marks(docs):
    marks = ("[prefix]", "[suffix]", "[middle]")
    rows = [(i, f"a few words for number {i} <P>") for i in range(20)]
    moved = fim.rearrange(fim.with_index(docs(rows)), percent=100, marks=marks)
    out = moved.select("record.doc_id", "form", fim.restored("output", "form", marks).alias("text")).collect()
    assert sorted((r.doc_id, r.text) for r in out) == rows and {r.form for r in out} == {"spm", "psm"}


def test_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = []
    for r in rows:
        n, form, start, end, output = brute(r.doc_id, r.text)
        expected.append((r.doc_id, n, form, start, None if start is None else end - start, sha(output), sha(r.text or "")))
    out = queries.op13_fill_in_middle(spark, SMALL).collect()
    names = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    assert sorted(tuple(r[n] for n in names) for r in out) == sorted(expected)
