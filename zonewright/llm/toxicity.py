"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded words.

Texts are folded first: lower case, accents off, letters of other scripts that
look like Latin ones, and digits and signs that stand for letters inside a word
("1d10t", "ѕtupid"). The lexicon holds a short list of common insults, and beginnings
of words that the labelled rows teach. A hit inside an exception phrase
doesn't count. The sum of the weights is held against the logarithm of the length.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from zonewright.llm.common import map_texts, whole_rows
from zonewright.session import materialize

#: Labelled rows that the lexicon is learned from, about, where there are more; chosen by a hash of their key.
TRAINING_ROWS = 30_000

#: Shortest and longest beginning of a word that can be learned.
SHORTEST, LONGEST = 4, 10

#: An entry needs this share of the toxic training rows, so many of them at least,
#: this weight, the logarithm of how much more often toxic rows have it, and this
#: evidence, the log-likelihood ratio against the same share in toxic and other rows.
SHARE, ROWS, WEIGHT, EVIDENCE = 0.01, 4, 3.0, 30.0

#: An entry with this share and weight counts also where others already cover its rows.
WIDE_SHARE, WIDE_WEIGHT = 0.05, 5.0

#: Weight of a listed insult that the labels say nothing about.
LISTED_WEIGHT = 5.0

#: Score from which a text is toxic.
THRESHOLD = 0.3

# Common insults.
INSULTS = (
    "asshole bastard bitch clown coward cretin creep disgusting dumbass fool freak garbage idiot imbecile jerk loser lowlife "
    "maggot moron parasite pathetic pervert pig psycho scum slut stupid trash vermin whore worthless"
).split()

# Phrases in which such words are meant otherwise.
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "trash collection", "trash pickup", "clown fish", "circus clown", "clown car",
    "pond scum", "garbage can", "garbage collect", "garbage truck", "garbage bag", "guinea pig", "pig farm", "pig iron",
    "jerk chicken", "jerk seasoning", "fool proof", "april fool", "creeping plant", "creep rate", "freak wave", "freak storm",
    "parasite drag", "bastard file", "psychology", "psycholog",
)

# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = dict(zip("аеорсухіјѕԁһԛԝвкмнтαεικνορτυχβγωɑɡıⅼ", "aeopcyxijsdhqwbkmhtaeiknoptuxbywagil", strict=True))

# Digits and signs that stand for letters next to letters.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}


@dataclass(frozen=True)
class Lexicon:
    """Beginnings of folded words, or whole words with a space at the end, and their weights; exception phrases."""

    weights: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...] = EXCEPTIONS


def _plain(c: str) -> str:
    """A letter without accents, case and script."""
    base = unicodedata.normalize("NFKD", c.lower())
    base = "".join(x for x in base if not unicodedata.combining(x))
    return "".join(HOMOGLYPHS.get(x, x) for x in base) or c


class _Fold(dict):
    """For str.translate: letters and digits folded, all else a space but signs that may stand for letters."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        folded = "" if unicodedata.combining(c) or c in "­​‌‍" else c if c in "@$!" else _plain(c) if c.isalnum() else " "
        self[code] = folded
        return folded


_FOLD = _Fold()
_SPELLED = re.compile(r"(?<=[a-z])[0134578@$!]+(?=[a-z])|(?<![a-z0-9@$!])[0134578@$]+(?=[a-z])|(?<=[a-z])[0134578@$]+(?![a-z0-9@$!])")
_SIGNS = re.compile(r"[@$!]+")
_DIGITS = str.maketrans(DIGITS)


def fold(text: str) -> str:
    """Folded words with a space before each; digits and signs next to letters become letters."""
    out = text.translate(_FOLD)
    if _SPELLED.search(out):
        out = _SPELLED.sub(lambda m: m[0].translate(_DIGITS), out)
    return " " + " ".join(_SIGNS.sub(" ", out).split()) + " "


@lru_cache(4)
def _automaton(lexicon: Lexicon) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for phrase in lexicon.exceptions:
        automaton.add_word(" " + phrase, (len(phrase) + 1, 0.0))
    for word, weight in lexicon.weights:
        automaton.add_word(" " + word, (len(word) + 1, weight))
    automaton.make_automaton()
    return automaton


def hits(text: str, lexicon: Lexicon) -> tuple[float, int]:
    """Weight of all hits, the longest entry for each word, and the number of words."""
    folded = fold(text)
    best: dict[int, tuple[int, float]] = {}
    spared: list[tuple[int, int]] = []
    for end, (length, weight) in _automaton(lexicon).iter(folded):
        start = end - length + 1
        if weight == 0.0:
            spared.append((start, end))
        elif length > best.get(start, (0, 0.0))[0]:
            best[start] = (length, weight)
    total = sum(w for at, (_, w) in best.items() if not any(a <= at <= b for a, b in spared))
    return total, folded.count(" ") - 1


def score(text: str, lexicon: Lexicon) -> float:
    """0 to 1: the weight of the hits, held against the logarithm of the number of words."""
    weight, words = hits(text, lexicon)
    return 1.0 - math.exp(-weight / (1.0 + math.log1p(max(words, 0)))) if weight > 0 else 0.0


def _beginnings(text: str) -> set[str]:
    words = set(fold(text).split())
    return {w[:n] for w in words for n in range(SHORTEST, min(len(w), LONGEST) + 1)}


def _copies_key(text: str) -> int:
    """The least hash of the text's runs of five words, which near copies mostly share."""
    words = text.split()
    return min((zlib.crc32(" ".join(words[i : i + 5]).encode()) for i in range(max(1, len(words) - 4))), default=0)


def _different(rows: DataFrame) -> DataFrame:
    """One text, the first in order, of those that share their copies' key."""
    schema = T.StructType([T.StructField("__copies", T.LongType()), T.StructField("__text", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array([_copies_key(t) for t in batch.column(0).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([keys, batch.column(0)], schema=arrow)

    keyed = rows.select("__text").mapInArrow(run, schema)
    return keyed.groupBy("__copies").agg(F.min("__text").alias("__text"))


def _found(rows: DataFrame, of: frozenset[str] | None, counted: bool) -> DataFrame:
    """Beginnings of words in each text, only those in ``of``: as lists, or as counts of rows for each Arrow batch."""
    kinds = [T.StructField("entry", T.StringType()), T.StructField("n", T.LongType())]
    schema = T.StructType(kinds if counted else [T.StructField("entries", T.ArrayType(T.StringType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = (_beginnings(x) for x in batch.column(0).to_pylist())
            made = made if of is None else (x & of for x in made)
            if counted:
                sums = Counter(e for x in made for e in x)
                columns = [list(sums.keys()), list(sums.values())]
            else:
                columns = [[sorted(x) for x in made]]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, arrow, strict=True)], schema=arrow)

    found = rows.select("__text").mapInArrow(run, schema)
    return found.groupBy("entry").agg(F.sum("n").alias("n")) if counted else found


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Lexicon:
    """The listed insults and the beginnings of words that toxic rows have far more often.

    Rows: the distinct texts whose key has a label of 0 or 1, of which about ``TRAINING_ROWS`` by hashes of
    the key and of the text; so what comes to the driver is bounded however many rows a key has. A key with several labels
    counts as toxic if one is 1, and so does a text that several keys have. Without toxic or without other rows the
    list alone is the lexicon.
    """
    marked = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias("__toxic"))
    marked = marked.select(F.col(key).alias("__key"), "__toxic")
    some = F.pmod(F.xxhash64("__key"), F.lit(max(marked.count(), 1))) < TRAINING_ROWS
    rows = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text")).where("__text IS NOT NULL")
    # about TRAINING_ROWS keys are small enough to broadcast; equal texts are one row, combined before they are shuffled
    rows = rows.join(F.broadcast(marked.where(some)), "__key")
    rows = rows.groupBy(F.xxhash64("__text").alias("__hash")).agg(F.max("__toxic").alias("__toxic"), F.min("__text").alias("__text"))
    # a key may have any number of texts: these are cut once more, by a hash
    rows = materialize(rows, "labelled")
    n_texts = rows.count()
    if n_texts > TRAINING_ROWS:
        rows = materialize(rows.where(F.pmod(F.xxhash64("__hash"), F.lit(n_texts)) < TRAINING_ROWS), "labelled")
    sizes = {r["__toxic"]: r["n"] for r in rows.groupBy("__toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not other:
        return Lexicon(tuple(sorted(_listed({}, {}, other).items())))
    # what only copies of one text have in common tells nothing, so those count once
    of_toxic, of_other = materialize(_different(rows.where("__toxic = 1")), "toxic"), rows.where("__toxic = 0")
    toxic = of_toxic.count()
    least = max(ROWS, math.ceil(SHARE * toxic))
    often = {r["entry"]: r["n"] for r in _found(of_toxic, None, True).where(F.col("n") >= least).collect()}
    rest = {r["entry"]: r["n"] for r in _found(of_other, frozenset(often) | frozenset(INSULTS), True).collect()}
    weight = {e: math.log((n + 0.5) / (toxic + 1) * (other + 1) / (rest.get(e, 0) + 0.5)) for e, n in often.items()}
    evidence = {e: _likelihood_ratio(n, toxic, rest.get(e, 0), other) for e, n in often.items()}
    strong = _grown({e for e, w in weight.items() if w >= WEIGHT and evidence[e] >= EVIDENCE}, often)
    chosen = _covering([frozenset(r["entries"]) for r in _found(of_toxic, frozenset(strong), False).collect()], weight, least)
    chosen |= {e for e in strong if often[e] >= max(ROWS, WIDE_SHARE * toxic) and weight[e] >= WIDE_WEIGHT}
    chosen = {e for e in chosen if not any(e[:n] in chosen for n in range(SHORTEST, len(e)))}
    listed = {w: x for w, x in _listed(rest, often, other).items() if not any(w.startswith(e) for e in chosen)}
    return Lexicon(tuple(sorted(({e: weight[e] for e in chosen} | listed).items())))


def _likelihood_ratio(a: int, of_a: int, b: int, of_b: int) -> float:
    """Twice the gain in log-likelihood of two shares, a of of_a and b of of_b, over one for both."""

    def log_likelihood(k: int, n: int, share: float) -> float:
        return sum(c * math.log(p) for c, p in ((k, share), (n - k, 1 - share)) if c)

    both = (a + b) / (of_a + of_b)
    alone = log_likelihood(a, of_a, a / of_a) + log_likelihood(b, of_b, b / of_b)
    return 2 * (alone - log_likelihood(a, of_a, both) - log_likelihood(b, of_b, both))


def _listed(rest: dict[str, int], often: dict[str, int], other: int) -> dict[str, float]:
    """The listed insults as whole words, without those that other rows have and toxic rows hardly."""
    fine = [w for w in INSULTS if rest.get(w, 0) <= max(2, SHARE / 10 * other) or w in often]
    return {f"{w}{end} ": LISTED_WEIGHT for w in fine for end in ("", "s")}


def _grown(entries: set[str], rows: dict[str, int]) -> set[str]:
    """Entries without those that a letter more leaves nearly all rows."""
    return entries - {e[:-1] for e in entries if rows[e] >= 0.95 * rows.get(e[:-1], 0)}


def _covering(rows: list[frozenset[str]], weight: dict[str, float], least: int) -> set[str]:
    """Entries taken one by one, each the one with most weight in rows that none before is in.

    So the many rare words of a toxic text's copies don't get in beside the one that makes it toxic.
    """
    chosen: set[str] = set()
    while True:
        left = Counter(e for x in rows for e in x)
        best = max(left, key=lambda e: (left[e] * weight[e], e), default=None)
        if best is None or left[best] < least:
            return chosen
        chosen.add(best)
        rows = [x for x in rows if best not in x]


def score_texts(docs: DataFrame, lexicon: Lexicon, keep: list[str], text: str = "text", column: str = "score") -> DataFrame:
    """Columns ``keep`` and the score of each whole text.

    Null and empty texts, and texts without a word, score 0. Rows are independent:
    repeated rows and extra columns change nothing, an empty table gives an empty one.
    """
    new = [T.StructField(column, T.DoubleType())]
    return map_texts(docs, keep, text, new, lambda texts: [(score(t.decode(), lexicon) if t else 0.0,) for t in texts])


def score_rows(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """``record``, a struct of all columns, and ``score``."""
    return score_texts(whole_rows(docs, text), lexicon, ["record"])
