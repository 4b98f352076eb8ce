"""Byte-level BPE: a backtracking encoder that is linear in the text, and an offset-table decoder.

A token sequence is the result of the merges exactly if every two neighbours are
compatible, which means that no merge across their border comes up before the
merges that build them. So the encoder needs no merge loop: an Aho-Corasick
automaton lists the longest token at each position, the encoder takes it if it is
compatible with the token before, else the next shorter one, and steps back where
none fits. Each position is given up once at most.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from zonewright.llm.common import map_texts

#: Pre-tokens whose ids a task remembers before it starts afresh.
REMEMBERED = 200_000

NEVER = 1 << 60


def _byte_letters() -> dict[str, int]:
    """Letters that vocabulary files of this kind write for bytes: printable ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(None)
def _ranges(unicode_property: str, plane: int) -> str:
    """The characters of a property up to ``plane`` as the inside of a character class of ``re``."""
    everything = "".join(map(chr, (*range(min(plane, 0xD800)), *range(0xE000, plane))))
    found = regex.findall(rf"\p{{{unicode_property}}}+", everything)
    return "".join(f"{re.escape(x[0])}-{re.escape(x[-1])}" for run in found for x in _consecutive(run))


def _consecutive(run: str):
    start = 0
    for i in range(1, len(run) + 1):
        if i == len(run) or ord(run[i]) != ord(run[i - 1]) + 1:
            yield run[start:i]
            start = i


@lru_cache(None)
def _pattern(plane: int) -> re.Pattern:
    letter, number, space = (_ranges(x, plane) for x in ("L", "N", "White_Space"))
    return re.compile(
        rf" ?[{letter}]+|'(?:[stmd]|re|ve|ll)| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


_BEYOND_BMP = re.compile("[\U00010000-\U0010ffff]")


def pre_tokens(text: str) -> list[str]:
    """The usual split before byte-level merges.

    ``re`` tests a character class by a bitmap as long as the class stays within the
    first plane, so the class is cut to what the text can hold.
    """
    plane = 0x80 if text.isascii() else 0x110000 if _BEYOND_BMP.search(text) else 0x10000
    return _pattern(plane).findall(text)


class _Remembered(dict):
    """Ids of a pre-token, as little-endian bytes."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = array("I", self.encode(word.encode())).tobytes()
        return ids


class ByteBpe:
    """Tables of one vocabulary file in the tokenizers library's JSON format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True)
        if not plain or split.get("add_prefix_space") or spec["normalizer"] or model.get("byte_fallback"):
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        letters = _byte_letters()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens that take up text around them")
        written = {k: v for k, v in model["vocab"].items() if k not in added}
        token = {v: bytes(letters[c] for c in k) for k, v in written.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # rank of a pair, and for each merged token its halves and rank
        self.rank = {(written[a], written[b]): r for r, (a, b) in reversed(list(enumerate(pairs)))}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for r, (a, b) in enumerate(pairs):
            self.halves.setdefault(written[a + b], (written[a], written[b], r))
        self.fits: dict[int, bool] = {}
        # a token that its own text isn't encoded to never comes out of the merges
        reached = {t for t in token if t not in self.halves and len(token[t]) == 1}
        reached |= {t for t, (a, b, r) in self.halves.items() if not self._crosses(a, b, r)}
        self.ids = {token[t]: t for t in sorted(reached, reverse=True)}
        self.length = {t: len(token[t]) for t in reached}
        self.shorter = {
            t: next((self.ids[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in self.ids), -1) for b, t in self.ids.items()
        }
        self.automaton = ahocorasick.Automaton()
        for b, t in self.ids.items():
            self.automaton.add_word(b.decode("latin-1"), t)
        self.automaton.make_automaton()
        self.added = {k: array("I", [v]).tobytes() for k, v in added.items()}
        longest_first = sorted(added, key=len, reverse=True)
        self.added_split = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        self.remembered = _Remembered(self.word)

    def _crosses(self, left: int, right: int, before: int = NEVER) -> bool:
        """Whether a merge across the border comes up while both of its sides stand at the border.

        A symbol at the border lasts until the merge that takes it further into its
        own token. At equal ranks the merge further left goes first.
        """
        a, a_ends = left, before
        while True:
            b, b_ends = right, before
            while True:
                r = self.rank.get((a, b), NEVER)
                if r < a_ends and (r < b_ends or r == b_ends != before):
                    return True
                if b not in self.halves:
                    break
                b, _, b_ends = self.halves[b]
            if a not in self.halves:
                return False
            _, a, a_ends = self.halves[a]

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > REMEMBERED:
                self.fits.clear()
            known = self.fits[key] = not self._crosses(left, right)
        return known

    def word(self, text: bytes) -> list[int]:
        """Ids of one pre-token."""
        if text in self.ids:
            return [self.ids[text]]
        letters, fits, length, shorter = text.decode("latin-1"), self.fits, self.length, self.shorter
        longest = self.automaton.iter_long
        tokens: list[int] = []
        dead: set[int] = set()  # positions from which no encoding goes on
        at, token, size = 0, -1, len(letters)
        matches = longest(letters)
        while at < size:
            if token < 0:
                token = next(matches)[1]
            last = tokens[-1] if tokens else -1
            while token >= 0:
                key = last << 32 | token
                if at + length[token] not in dead and (last < 0 or (fits[key] if key in fits else self.compatible(last, token))):
                    break
                token, matches = shorter[token], None
            if token >= 0:
                tokens.append(token)
                at, token = at + length[token], -1
            else:
                dead.add(at)
                tokens.pop()
                at -= length[last]
                token = shorter[last]
            if matches is None and token < 0:
                matches = longest(letters, at)
        return tokens

    def forget(self) -> None:
        """Keeps the tables only."""
        self.remembered.clear()
        self.fits.clear()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        parts = self.added_split.split(text) if self.added_split else [text]
        known = self.remembered
        out = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(self.added[part])
                continue
            out += map(known.__getitem__, pre_tokens(part))
            if len(known) > REMEMBERED:
                known.clear()
        return b"".join(out)


class OffsetTable:
    """The bytes of all tokens in one row, and where each begins."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        token = {v: k for k, v in spec["model"]["vocab"].items()}
        plain = {i: bytes(letters[c] for c in k) for i, k in token.items() if all(c in letters for c in k)}
        plain |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        parts = [plain.get(i, b"") for i in range(max(plain) + 1)]
        self.blob = np.frombuffer(b"".join(parts), np.uint8)
        self.offsets = np.cumsum([0, *map(len, parts)])

    def decode(self, ids: bytes) -> str:
        """One gather over the offset table; bytes that are no UTF-8 become replacement characters."""
        tokens = np.frombuffer(ids, "<u4")
        starts = self.offsets[tokens]
        sizes = self.offsets[tokens + 1] - starts
        ends = np.cumsum(sizes)
        gather = np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.blob[gather].tobytes().decode("utf-8", "replace")


@lru_cache(2)
def load(path: str) -> ByteBpe:
    """Tables of a vocabulary, once per Python worker."""
    return ByteBpe(path)


@lru_cache(2)
def load_offsets(path: str) -> OffsetTable:
    """The offset table of a vocabulary, once per Python worker."""
    return OffsetTable(path)


def encode(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers) of each whole text.

    A null text counts as empty: no tokens, empty ids. Rows are independent, so
    repeated rows and extra columns change nothing, an empty table gives an empty
    one, and there is no shuffle. Strings of added tokens inside a text become that
    token, as in the library. ``path`` must be readable on the executors.
    """

    def rows(texts):
        bpe = load(path)
        ids = [bpe.encode(t.decode()) if t else b"" for t in texts]
        return [(len(x) // 4, x) for x in ids]

    new = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    return map_texts(docs, keep, text, new, rows, lambda: load(path).forget())


def decode(encoded: DataFrame, path: str, keep: list[str], ids: str = "ids") -> DataFrame:
    """Columns ``keep`` and ``decoded``, the text of each row's ids; null ids give an empty text."""

    def rows(all_ids):
        table = load_offsets(path)
        return [(table.decode(x) if x else "",) for x in all_ids]

    return map_texts(encoded, keep, ids, [T.StructField("decoded", T.StringType())], rows)


def round_trip(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """As :func:`encode`, with ``round_trip``: whether the ids decode to the text, in the same pass over it."""

    def rows(texts):
        bpe, table = load(path), load_offsets(path)
        ids = [bpe.encode(t.decode()) if t else b"" for t in texts]
        return [(len(x) // 4, x, table.decode(x) == (t or b"").decode()) for x, t in zip(ids, texts, strict=True)]

    new = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("round_trip", T.BooleanType())]
    return map_texts(docs, keep, text, new, rows, lambda: load(path).forget())
