"""Licence notices by a positional index of rare words.

The index holds, for the highest-IDF words of each template, the templates and
positions they stand at: as many as a text can't lack all of and still reach the
least score. Each of a text's occurrences of such words gives a place at which a
template may start; it is compared word by word, and must hold the key phrases.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from zonewright.llm.common import map_texts

#: Share of a template's IDF that a text must have at the right places.
LEAST_SCORE = 0.8


@dataclass(frozen=True)
class Template:
    """label, a notice's words, and phrases without which it doesn't count. exact: no word may differ."""

    label: str
    text: str
    phrases: tuple[str, ...] = ()
    exact: bool = False


# Phrases that name a licence by themselves.
PHRASES = (
    Template("mit", "under the mit license", exact=True),
    Template("apache-2", "apache license version 2", exact=True),
    Template("cc-by-nc", "cc by nc", exact=True),
)

# First sentences of public licences and of the notices that refer to them.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
             "documentation files the software to deal in the software without restriction", ("without restriction",)),
    Template("mit", "spdx license identifier mit", ("identifier mit",)),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
             "with the license", ("apache license",)),
    Template("apache-2", "spdx license identifier apache 2 0", ("apache 2",)),
    Template("gpl-3", "licensed under the gnu general public license version 3", ("general public license", "version 3")),
    Template("gpl-2", "licensed under the gnu general public license version 2", ("general public license", "version 2")),
    Template("gpl-3", "redistribute it and or modify it under the terms of the gnu general public license as published by the free "
             "software foundation either version 3 of the license", ("gnu general public license", "version 3")),
    Template("gpl-2", "redistribute it and or modify it under the terms of the gnu general public license as published by the free "
             "software foundation either version 2 of the license", ("gnu general public license", "version 2")),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation",
             ("gnu lesser general public license",)),
    Template("agpl-3", "under the terms of the gnu affero general public license as published by the free software foundation",
             ("gnu affero general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
             "following conditions are met", ("source and binary forms",)),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ("with or without fee",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
    Template("boost", "distributed under the boost software license version 1 0", ("boost software license",)),
    Template("epl", "made available under the terms of the eclipse public license", ("eclipse public license",)),
    Template("cc0", "to the extent possible under law the author has dedicated all copyright and related and neighboring rights to the "
             "public domain", ("public domain",)),
    Template("cc-by", "licensed under cc by 4 0", ("cc by 4",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
             ("creative commons attribution 4",)),
    Template("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license",
             ("attribution sharealike",)),
    Template("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
             ("attribution noncommercial",)),
    Template("proprietary", "all rights reserved no part of this publication may be reproduced", ("all rights reserved",)),
)

_WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TO_WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _WORD_BYTES else 0x20 for c in range(256))


def words(text: bytes) -> list[bytes]:
    """Runs of digits, letters a to z after lower-casing A to Z, and everything beyond ASCII."""
    return text.translate(_TO_WORDS).split()


def _find(where: list[bytes], phrase: list[bytes]) -> bool:
    return any(where[i : i + len(phrase)] == phrase for i in range(len(where) - len(phrase) + 1))


class Index:
    """Positions of each template's rarest words."""

    def __init__(self, templates: tuple[Template, ...]):
        self.templates = templates
        self.words = [words(t.text.encode()) for t in templates]
        self.phrases = [[words(p.encode()) for p in t.phrases] for t in templates]
        having = Counter(w for x in self.words for w in set(x))
        self.idf = {w: math.log(1 + len(templates) / n) for w, n in having.items()}
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, own in enumerate(self.words):
            total = rest = sum(self.idf[w] for w in own)
            # of equally rare words the longer ones, which fewer texts hold by chance
            for p in sorted(range(len(own)), key=lambda p, own=own: (-self.idf[own[p]], -len(own[p]), p)):
                self.postings[own[p]].append((t, p))
                rest -= self.idf[own[p]]
                if rest < (LEAST_SCORE - 1e-9) * total:
                    break

    def places(self, text: list[bytes]) -> list[tuple[int, int, float]]:
        """All (template, first word, score) of a text's words, a score of 1 being the same words."""
        postings = self.postings
        found = dict.fromkeys((t, i - p) for i, w in enumerate(text) if w in postings for t, p in postings[w])
        out = []
        for t, at in found:
            if at < 0:
                continue
            own = self.words[t]
            window = text[at : at + len(own)]
            if self.templates[t].exact:
                if window == own:
                    out.append((t, at, 1.0))
                continue
            total = sum(self.idf[w] for w in own)
            score = sum(self.idf[w] for w, x in zip(own, window, strict=False) if w == x) / total
            if score >= LEAST_SCORE and all(_find(window, p) for p in self.phrases[t]):
                out.append((t, at, score))
        return out


@lru_cache(2)
def _index(templates: tuple[Template, ...]) -> Index:
    return Index(templates)


COLUMNS = [
    *(T.StructField(c, T.LongType()) for c in ("n_words", "n_base", "first_word", "last_word")),
    T.StructField("base_labels", T.StringType()),
    T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()),
]


def scan_texts(
    docs: DataFrame,
    keep: list[str],
    text: str = "text",
    phrases: tuple[Template, ...] = PHRASES,
    notices: tuple[Template, ...] = NOTICES,
) -> DataFrame:
    """Columns ``keep`` and ``COLUMNS`` of each whole text: all places of ``phrases``, and the labels of both.

    ``score`` is that of the best place, 0 without any. Null and empty texts have no
    words, no places (null first and last word) and empty labels. Rows are independent:
    repeated rows and extra columns change nothing, an empty table gives an empty one,
    and there is no shuffle. All places in a text are found, however many.
    """

    def scan(data: bytes) -> tuple:
        index = _index((*phrases, *notices))
        own = words(data)
        places = index.places(own)
        base = [(at, index.templates[t].label) for t, at, _ in places if t < len(phrases)]
        labels = {index.templates[t].label for t, _, _ in places}
        return (
            len(own),
            len(base),
            min((at for at, _ in base), default=None),
            max((at for at, _ in base), default=None),
            ",".join(sorted({x for _, x in base})),
            ",".join(sorted(labels)),
            max((score for *_, score in places), default=0.0),
        )

    return map_texts(docs, keep, text, COLUMNS, lambda texts: [scan(t or b"") for t in texts])
