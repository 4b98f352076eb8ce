"""Quality by compression bands, with a few plain counts.

Repetitive text compresses far better than prose of its length, random or encoded
text far worse. Whole texts and fixed chunks of them are compressed with zstandard;
the limits depend on the length, because longer texts compress better.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from zonewright.llm.common import map_texts, whole_rows


@dataclass(frozen=True)
class Bands:
    """Limits of compressed size over size, for zstandard's level.

    whole: for texts of up to so many bytes, the least and the highest ratio.
    chunk: bytes of a chunk, and its limits; the last one ends with the text and may overlap the one before. A text
    shorter than a chunk has none: its whole is judged.
    bad_share: a text goes if more than this share of its chunks is out of the limits.
    """

    level: int = 3
    # The least ratios are for clearly repetitive texts: natural English of a few KB up to 35 KB lies at least 0.08 above them.
    whole: tuple[tuple[int, float, float], ...] = (
        (256, 0.40, 0.95),
        (512, 0.38, 0.85),
        (1024, 0.36, 0.78),
        (2048, 0.33, 0.72),
        (4096, 0.30, 0.68),
        (8192, 0.27, 0.66),
        (16384, 0.25, 0.65),
        (32768, 0.23, 0.64),
        (1 << 20, 0.20, 0.63),
        (1 << 62, 0.15, 0.63),
    )
    chunk: tuple[int, float, float] = (2048, 0.33, 0.66)
    bad_share: float = 0.25


#: Words that a text must have at least, and the percentage of them that may be repeated.
LEAST_WORDS, REPEATED_PERCENT = 50, 50

#: Symbols, and how many of them to a hundred words a text may have.
SYMBOLS, SYMBOL_PERCENT = b"#*$%&|<>", 25

COLUMNS = [
    *(T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("whole_ratio", T.DoubleType()),
    T.StructField("n_chunks", T.LongType()),
    T.StructField("n_bad_chunks", T.LongType()),
    T.StructField("rejected_by", T.StringType()),
    T.StructField("kept", T.BooleanType()),
]


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three that comes twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    count = reached = 0
    for i, window in enumerate(windows):
        if times[window] > 1:
            count += i + 3 - max(i, reached)
            reached = i + 3
    return count


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


class Judge:
    def __init__(self, bands: Bands, symbol_percent: int | None):
        self.bands, self.symbol_percent = bands, symbol_percent
        self.sizes = [size for size, _, _ in bands.whole]
        self.compressor = zstandard.ZstdCompressor(level=bands.level, write_content_size=False, write_checksum=False)

    def ratio(self, data: bytes) -> float:
        return len(self.compressor.compress(data)) / len(data) if data else 0.0

    def __call__(self, text: bytes) -> tuple:
        words = text.split()  # on bytes: ASCII white space only
        n_repeat = repeated_words(words)
        failed = len(words) < LEAST_WORDS or 100 * n_repeat > REPEATED_PERCENT * len(words)
        whole = self.ratio(text)
        _, least, most = self.bands.whole[bisect_left(self.sizes, len(text))]
        size, low, high = self.bands.chunk
        starts = [*range(0, len(text) - size + 1, size)]
        if starts and len(text) % size:
            starts.append(len(text) - size)
        chunks = [text[i : i + size] for i in starts]
        bad = sum(not low <= self.ratio(x) <= high for x in chunks)
        symbols = sum(text.count(c) for c in SYMBOLS)
        reasons = {
            "words": failed,
            "whole below": whole < least,
            "whole above": whole > most,
            "chunks": bad > self.bands.bad_share * len(chunks),
            "symbols": self.symbol_percent is not None and 100 * symbols > self.symbol_percent * len(words),
        }
        out = [reason for reason, found in reasons.items() if found]
        chars = len(b"".join(words).decode())
        return len(words), chars, symbols, duplicate_lines(text), n_repeat, failed, whole, len(chunks), bad, ",".join(out), not out


def judge_texts(
    docs: DataFrame, keep: list[str], text: str = "text", bands: Bands = Bands(), symbol_percent: int | None = SYMBOL_PERCENT
) -> DataFrame:
    """Columns ``keep`` and ``COLUMNS`` for each whole text; ``rejected_by`` names the rules that it fails.

    Besides the compression bands, texts strewn with symbols go; without ``symbol_percent`` the bands alone judge
    what has words enough.

    Null, empty and blank texts have no words, so they fail. Rows are independent:
    repeated rows and extra columns change nothing, an empty table gives an empty one,
    and there is no shuffle.
    """

    def rows(texts):
        judge = Judge(bands, symbol_percent)
        return [judge(t or b"") for t in texts]

    return map_texts(docs, keep, text, COLUMNS, rows)


def judge_rows(docs: DataFrame, text: str = "text", bands: Bands = Bands()) -> DataFrame:
    """``record``, a struct of all columns, and ``COLUMNS``."""
    return judge_texts(whole_rows(docs, text), ["record"], bands=bands)
