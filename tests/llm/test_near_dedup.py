"""Groups against all pairs compared in plain Python; signatures against their definition."""

import random

import numpy as np
import pytest

from tests.conftest import SMALL
from zonewright.llm import near_dedup as nd
from zonewright.llm import queries


def brute(rows):
    """Smallest key reachable of each row, comparing all pairs."""
    sets = [nd.shingle_set((t or "").encode()) for _, t in rows]
    parent = {k: k for k, _ in rows if k is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            common = len(sets[i] & sets[j])
            if None not in (a, b) and common and 100 * common >= 85 * len(sets[i] | sets[j]):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    return sorted((k, len(s), find(k), find(k) == k) for (k, _), s in zip(rows, sets, strict=True) if k is not None)


def found(df):
    rows = nd.groups(df).collect()
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is not None)


def edited(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    """Copies with few to many edits, chains, shared passages, short and odd texts."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(1, 7)))
    texts = []
    for _ in range(6):
        base = [word() for _ in range(rng.choice([8, 40, 150, 600]))]
        texts += [edited(base, rng, rng.randint(0, max(1, len(base) // 40))) for _ in range(25)]
    chain = [word() for _ in range(120)]
    for _ in range(12):  # each is near the one before only
        chain = chain[2:] + [word(), word()]
        texts.append(" ".join(chain))
    passage = " ".join(word() for _ in range(30))
    texts += [f"{passage} {' '.join(word() for _ in range(rng.randint(3, 40)))}" for _ in range(40)]
    texts += [None, "", " \n", "one", "One", "one two", "a b c d e", "A b  c\td e", "a b c d", "x " * 30_000, "x " * 20_000]
    texts += [texts[3]] * 20
    rng.shuffle(texts)
    return [(i * 7 % 1009, t) for i, t in enumerate(texts)]


def test_groups_equal_all_pairs(docs, corpus):
    assert found(docs(corpus)) == brute(corpus)


def test_repeated_rows_one_key_with_two_texts_and_no_key(docs):
    a, b = "some words that make a text of ten words here", "quite another text that has not one word in common"
    rows = [(5, a), (5, a), (3, a), (9, b), (5, b), (None, a), (None, None), (7, None), (2, "alone")]
    assert found(docs(rows)) == [(2, 1, 2, True), (3, 6, 3, True), (5, 6, 3, False), (5, 6, 3, False), (5, 6, 3, False), (7, 0, 7, True), (9, 6, 3, False)]
    free = [r for r in nd.groups(docs(rows)).collect() if r.doc_id is None]
    assert [(r.component_id, r.kept) for r in free] == [(None, True)] * 2


def test_an_empty_table(docs):
    assert found(docs([])) == []
    assert found(docs([(1, None), (2, "")])) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 900)] + [(7, 7), (139, 2)]
    df = spark.createDataFrame(edges, "a long, b long")
    roots = {r.id: r.root for r in nd.components(df).collect()}
    assert roots == {i: 2 for i in range(100, 141)} | {i: 500 for i in range(501, 900)}


def test_odd_sketches_estimate_and_bitmaps_bound():
    rng = random.Random(5)
    for edits in (1, 2, 5, 10, 30):
        base = [f"w{rng.random()}" for _ in range(400)]
        x, y = " ".join(base).encode(), edited(base, rng, edits).encode()
        sx, sy = nd.signature(x), nd.signature(y)
        xor = lambda i: sum(bin((p ^ q) & (1 << 64) - 1).count("1") for p, q in zip(sx[i], sy[i], strict=True))  # noqa: E731,B023
        a, b = nd.shingle_set(x), nd.shingle_set(y)
        bits = 64 * nd.SKETCH_WORDS
        estimate = 1 + bits / (4 * nd.BANDS * nd.ROWS) * np.log(1 - 2 * xor(4) / bits)
        assert abs(estimate - len(a & b) / len(a | b)) < 0.12
        assert xor(5) <= len(a ^ b)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    out = queries.op5_near_dedup(spark, SMALL).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out) == brute(rows)


def brute_at(rows, percent):
    """Smallest key reachable of each row with a set, by links of another percentage."""
    sets = {k: nd.shingle_set((t or "").encode()) for k, t in rows}
    root = {k: k for k in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                lo, hi = sorted((root[a], root[b]))
                root = {k: lo if r == hi else r for k, r in root.items()}
    return root


@pytest.mark.parametrize("percent", [80, 60])
def test_another_percentage(docs, corpus, percent):
    rng = random.Random(23)
    base = [f"{rng.random()}" for _ in range(104)]  # 100 shingles, of which the last k differ
    cut = [" ".join(base[: 104 - k] + [f"{rng.random()}" for _ in range(k)]) for k in (0, 9, 10, 11, 12, 13, 24, 25, 26)]
    rows = corpus + [(2000 + i, t) for i, t in enumerate(cut)]
    got = {r.doc_id: r.component_id for r in nd.groups(docs(rows), percent=percent).collect()}
    assert got == brute_at(rows, percent)


def test_bands_and_bounds_follow_the_percentage():
    for percent in (50, 70, 80, 85, 90, 99):
        bands, rows = nd.banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands < 1 / 3_500_000
        assert nd.least_estimate(percent) < percent / 100 - 0.05
        assert len(nd.signature(b"a b c d e f g", percent)[3]) == bands
    with pytest.raises(ValueError):
        nd.banding(100)


def test_wide_bitmaps_fold_and_never_overrate(spark):
    rng = random.Random(31)
    base = [f"w{rng.random()}" for _ in range(3000)]
    for n, k in ((3000, 40), (2100, 0), (1100, 3), (513, 2), (512, 1)):
        x, y = " ".join(base[:n]).encode(), edited(base[:n], rng, k).encode()
        sx, sy = nd.signature(x), nd.signature(y)
        assert (sx[6] is None) == (sx[0] <= nd.SET_ELEMENTS)
        if sx[6] is None:
            continue
        assert 64 * len(sx[6]) >= 2 * sx[0]
        folded = np.array(sx[6])
        while len(folded) > nd.SET_WORDS:
            folded = folded[: len(folded) // 2] ^ folded[len(folded) // 2 :]
        assert folded.tolist() == sx[5]
        if sy[6] is not None and len(sx[6]) == len(sy[6]):
            differing = sum(bin((p ^ q) & (1 << 64) - 1).count("1") for p, q in zip(sx[6], sy[6], strict=True))
            assert differing <= len(nd.shingle_set(x) ^ nd.shingle_set(y))


def template(n, edits, words=3000):
    """Texts of one template, each edited on its own, so that all pairs are alike."""
    rng = random.Random(n)
    base = [f"w{i}" for i in range(words)]
    return [(i, edited(base, rng, edits)) for i in range(n)]


def test_texts_of_a_template_that_do_not_link_are_not_written_out(docs, monkeypatch):
    rows = template(150, 36) + [(1000 + i, t) for i, (_, t) in enumerate(template(20, 5))]
    similar = nd.shingle_set(rows[0][1].encode()), nd.shingle_set(rows[1][1].encode())
    share = len(similar[0] & similar[1]) / len(similar[0] | similar[1])
    assert 0.75 < share < 0.83
    pairs = []
    keep = nd.materialize
    monkeypatch.setattr(nd, "materialize", lambda df, label: pairs.append((stored := keep(df, label)).count()) or stored if label == "pairs" else keep(df, label))
    got = found(docs(rows))
    assert got == brute(rows)
    assert sum(pairs) <= 4 * len(rows)  # of 11,175 pairs of the template


def test_sets_a_width_apart_link(docs):
    """2,048 elements have bitmaps of 64 words, one more those of 128."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(2052)]
    rows = [(i, " ".join(base[: 2052 - i * 3] + [f"own{i}" for _ in range(i % 2)])) for i in range(12)]
    rows += [(100 + i, " ".join(base + [f"more{i}x{j}" for j in range(i * 9)])) for i in range(1, 12)]
    rng.shuffle(rows)
    assert found(docs(rows)) == brute(rows)
