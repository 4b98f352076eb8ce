"""Token counts of whole texts by a sentencepiece BPE model, huge texts in overlapping chunks.

What makes a splice right: a BPE result is one exactly if every two neighbouring
tokens are the result for their own joint text, whatever stands around them. Two
chunks that overlap give two results for the overlap. Where both have the same
token at the same place, the first result up to that token and the second one from
it on hold only neighbours that stand together in one of the two results, so the
splice is the result of the whole. Without such a token the overlap is doubled.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from zonewright.llm.common import map_texts

#: Characters of a chunk, and of the first try at an overlap.
CHUNK, OVERLAP = 16_384, 64

SPACE = "▁"


class PieceCounter:
    """A sentencepiece model and the length of each piece in the normalised text."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap = chunk, overlap
        model, n = self.model, self.model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        self.bytes = np.array([1 if model.is_byte(i) else len(p.encode()) for i, p in enumerate(pieces)])
        # The proof needs that merges alone decide, and chunks that normalise as they do inside the text.
        sample = f"  a \t b{SPACE}Åﬁ \n"
        alone = "".join(model.encode(sample, out_type=str)) == SPACE + _bytes_for(model, sample.replace(" ", SPACE))
        odd = any(model.is_unused(i) for i in range(n)) or model.encode("<s>")[-1:] == [model.bos_id()]
        self.splices = alone and not odd

    def count(self, text: str) -> int:
        if len(text) <= self.chunk or not self.splices:
            return len(self.model.encode(text, num_threads=1))
        return len(self.ids(text))

    def _part(self, text: str, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a part, and the byte of the part's normalised text at which each starts.

        The model puts a space before each part. It takes the place of a space that the
        text has just there; else the first token is no token of the text.
        """
        ids = np.array(self.model.encode(text[start:stop], num_threads=1), np.int64)
        starts = np.cumsum(self.bytes[ids]) - self.bytes[ids] - len(SPACE.encode())
        return ids, starts

    def ids(self, text: str) -> np.ndarray:
        """Ids of a huge text, spliced."""
        done, (ids, starts) = 0, self._part(text, 0, self.chunk)
        out = []
        while done + self.chunk < len(text):
            end = done + self.chunk
            overlap = min(self.overlap, self.chunk // 2)
            while True:
                begin = end - overlap
                later, later_starts = self._part(text, begin, begin + self.chunk)
                shift = _size(text[done:begin])
                # the first token of a part may hold the space that was put there, the last one may be cut short
                mine = (starts[1:-1] - shift) * len(self.bytes) + ids[1:-1]
                theirs = later_starts[1:-1] * len(self.bytes) + later[1:-1]
                inside = _size(text[begin:end])
                common = np.intersect1d(mine[(starts[1:-1] >= shift) & (starts[1:-1] < shift + inside)], theirs)
                if len(common):
                    break
                if overlap >= self.chunk // 2:
                    return np.array(self.model.encode(text, num_threads=1), np.int64)
                overlap = min(2 * overlap, self.chunk // 2)
            at = common[len(common) // 2] // len(self.bytes)
            out.append(ids[: np.searchsorted(starts, at + shift)])
            keep = np.searchsorted(later_starts, at)
            done, ids, starts = begin, later[keep:], later_starts[keep:]
        return np.concatenate([*out, ids])


def _size(text: str) -> int:
    """Bytes of a text once its spaces are written as the model writes them."""
    return len(text.encode()) + (len(SPACE.encode()) - 1) * text.count(" ")


def _bytes_for(model, text: str) -> str:
    """The text with the characters that the model has no piece for written as byte pieces."""
    known = lambda c: model.piece_to_id(c) != model.unk_id()
    return "".join(c if known(c) else "".join(f"<0x{b:02X}>" for b in c.encode()) for c in text)


@lru_cache(2)
def load(path: str, chunk: int, overlap: int) -> PieceCounter:
    """A model, once per Python worker."""
    return PieceCounter(path, chunk, overlap)


def count_tokens(
    docs: DataFrame, path: str, keep: list[str], text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """Columns ``keep``, ``n_bytes`` (UTF-8) and ``n_tokens`` of each whole text, without begin and end tokens.

    A null or empty text has 0 bytes and 0 tokens. Texts of over ``chunk`` characters
    are encoded in overlapping chunks and give the same count as in one go. Rows are
    independent: repeated rows and extra columns change nothing, an empty table gives
    an empty one, and there is no shuffle. ``path`` must be readable on the executors.
    """

    def rows(texts):
        counter = load(path, chunk, overlap)
        return [(len(t), counter.count(t.decode())) if t else (0, 0) for t in texts]

    new = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    return map_texts(docs, keep, text, new, rows)
