"""Counts against plain definitions; what the compression bands reject."""

import random
import re
from pathlib import Path

import pytest

from tests.conftest import MEDIUM, SMALL
from zonewright.llm import quality, queries


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated), failed


def judged(docs, texts):
    df = docs(list(enumerate(texts))).withColumnRenamed("score", "n_words")
    return [r for _, r in sorted((r.doc_id, r) for r in quality.judge_texts(df, ["doc_id"]).collect())]


def counts(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_counts_equal_the_definitions(docs):
    rng = random.Random(7)
    parts = ["a", "b", "c", "é", "#x", "|", "\n", "\n", " ", "\t", "\x0b", "\x85", "　", "the"]
    texts = [" ".join(rng.choices(parts, k=rng.randint(0, 120))) for _ in range(100)]
    texts += [None, "", " \n\t", "same line\nsame line\n same line\n\n\n", "x y z x y z", "x x x x"]
    for text, r in zip(texts, judged(docs, texts), strict=True):
        assert counts(r) == brute(text)


def prose(n, seed=1):
    rng = random.Random(seed)
    syllables = "an the re on er st in ou ha to at es ing nd or ti le ve co mi pa".split()
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))


def test_bands_reject_repetitive_and_incompressible_texts(docs):
    rng = random.Random(3)
    code = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=6000))
    coded = " ".join(code[i : i + 60] for i in range(0, len(code), 60))
    loop = " ".join(f"item {i} of the very same list that goes on and on" for i in range(80))
    half = prose(2000) + " " + " ".join(f"number {i} {i}" for i in range(2000))
    fine, bad_code, bad_loop, bad_half, long = judged(docs, [prose(600), coded, loop, half, prose(60_000, 2)])
    assert fine.kept and long.kept
    assert not (bad_code.kept or bad_loop.kept or bad_half.kept)
    assert not bad_code.base_failed and bad_code.whole_ratio > 0.66
    assert bad_half.n_bad_chunks > 0.25 * bad_half.n_chunks


def test_blank_and_failing_texts_go(docs):
    assert [r.kept for r in judged(docs, [None, "", "one two", "a b c " * 100])] == [False] * 4
    assert quality.judge_texts(docs([]), ["doc_id"]).count() == 0


def test_whole_rows_keep_their_columns(docs):
    rows = quality.judge_rows(docs([(1, prose(300)), (1, prose(300)), (None, None)]))
    assert rows.count() == 3
    assert rows.where("kept").select("record.*").columns == docs([]).columns


def test_query_counts_and_good_rows(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in queries.op7_quality(spark, SMALL).collect():
        assert counts(r) == brute(texts[r.doc_id])
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").where("quality = 1").select("doc_id")
    good = queries.op7_quality(spark, MEDIUM).where("NOT base_failed").join(labels, "doc_id")
    assert good.where("NOT kept").count() <= 0.01 * good.count()


LICENCES = Path("/usr/share/common-licenses")


@pytest.mark.skipif(not LICENCES.is_dir(), reason="no natural texts on this machine")
def test_natural_texts_stay(docs):
    texts = [p.read_text() for p in sorted(LICENCES.iterdir()) if p.is_file()]
    assert len(texts) > 5 and all(r.kept for r in judged(docs, texts))


def test_prose_with_frequent_words_stays_whatever_its_length(docs):
    rng = random.Random(4)
    vocabulary = prose(20_000, 9).split()
    weights = [1 / (i + 1) ** 0.8 for i in range(len(vocabulary))]
    rows = judged(docs, [" ".join(rng.choices(vocabulary, weights, k=n)) for n in (400, 3000, 12_000, 300_000)])
    assert all(r.whole_ratio < 0.39 for r in rows[1:]) and all(r.kept for r in rows)


def test_symbols_reject_by_themselves(docs):
    words = prose(600).split()
    few, many = " ".join(f"{w}#" if i % 5 == 0 else w for i, w in enumerate(words)), " ".join(f"{w} |" for w in words)
    few, many = judged(docs, [few, many])
    assert few.kept and not many.kept and not many.base_failed


def test_the_end_of_a_text_is_judged_too(docs):
    start = prose(900)[:2048]
    end = prose(900, 3)[:1500]
    junk = " ".join(f"number {i} {i}" for i in range(1000))[:2047]
    fine, bad, short, exact = judged(docs, [start + end, start + junk, start[:2047], start])
    assert (fine.n_chunks, fine.n_bad_chunks, fine.kept) == (2, 0, True)
    assert (bad.n_chunks, bad.n_bad_chunks, bad.kept) == (2, 1, False) and not bad.base_failed
    assert (short.n_chunks, exact.n_chunks) == (0, 1)


def test_the_query_is_judged_by_the_bands_alone(spark):
    rows = queries.op7_quality(spark, SMALL).collect()
    assert all(r.kept == (not r.rejected_by) and "symbols" not in r.rejected_by and ("words" in r.rejected_by) == r.base_failed for r in rows)


def test_reasons_are_named(docs):
    loop = " ".join(f"item {i} of the very same list that goes on and on" for i in range(80))
    marked = " ".join(f"{w} |" for w in prose(600).split())
    fine, short, again, symbols = judged(docs, [prose(600), "one two", loop, marked])
    assert (fine.rejected_by, short.rejected_by.split(",")[0], symbols.rejected_by) == ("", "words", "symbols")
    assert "whole below" in again.rejected_by
