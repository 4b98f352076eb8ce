"""Licence places against a plain search for the phrases."""

import random
import re

from tests.conftest import SMALL
from zonewright.llm import license_scan as ls
from zonewright.llm import queries

PHRASES = {t.label: t.text.split() for t in ls.PHRASES}


def brute(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = [(i, label) for label, p in PHRASES.items() for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def scan(docs, texts):
    rows = ls.scan_texts(docs(list(enumerate(texts))).withColumnRenamed("kept", "labels"), ["doc_id"]).collect()
    return [r for _, r in sorted((r.doc_id, r) for r in rows)]


def test_base_places_equal_a_plain_search(docs):
    words = "under the mit license Apache-License, version 2 cc BY nc é Ünder 4 0 licensed".split()
    rng = random.Random(4)
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(200)]
    texts += ["under the mit license " * 500, "cc by nc " * 300, "", None, "x" * 200_000, "UNDER THE MIT LICENSE", "under\x00the\nmit/license"]
    for text, r in zip(texts, scan(docs, texts), strict=True):
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text)
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


def test_notices(docs):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    bsd = ls.NOTICES[10].text
    near = bsd.replace("forms", "shapes")
    one_off = bsd.replace("permitted", "allowed")
    rows = scan(docs, [gpl, bsd, near, one_off, "a general licence of the public", f"{gpl} {bsd} under the MIT license"])
    assert [r.labels for r in rows] == ["gpl-3", "bsd", "", "bsd", "", "bsd,gpl-3,mit"]
    assert rows[1].score == 1.0 and ls.LEAST_SCORE <= rows[3].score < 1


def test_every_template_finds_itself(docs):
    templates = [*ls.PHRASES, *ls.NOTICES]
    for t, r in zip(templates, scan(docs, [f"some words {t.text} more words" for t in templates]), strict=True):
        assert t.label in r.labels.split(","), t


def test_an_empty_table(docs):
    assert ls.scan_texts(docs([]), ["doc_id"]).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in queries.op4_license_scan(spark, SMALL).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])


def test_candidates_miss_no_place():
    rng = random.Random(8)
    index = ls.Index((*ls.PHRASES, *ls.NOTICES))
    found = 0
    for _ in range(600):
        t = rng.randrange(len(index.words))
        own = list(index.words[t])
        for p in rng.sample(range(len(own)), min(len(own), rng.randint(0, 3))):
            own[p] = b"other"
        text = [b"some"] * rng.randint(0, 3) + own + [b"more"]
        expected = set()
        for u, words in enumerate(index.words):
            total = sum(index.idf[w] for w in words)
            for at in range(len(text)):
                window = text[at : at + len(words)]
                same = sum(index.idf[w] for w, x in zip(words, window, strict=False) if w == x)
                if index.templates[u].exact:
                    ok = window == words
                else:
                    ok = same / total >= ls.LEAST_SCORE and all(ls._find(window, p) for p in index.phrases[u])
                if ok:
                    expected.add((u, at))
        assert {(u, at) for u, at, _ in index.places(text)} == expected
        found += len(expected)
    assert found > 300
