"""Fill-in-the-middle: texts cut at token boundaries, with their middle moved to the end.

Where a token ends is kept in a learned rank index. Straight segments predict the
offset of a boundary from its rank, each with a bounded error, and what is left over
is stored as one byte a boundary. So a cut at any rank is one look at a segment and
one byte, exact, and the same index serves every seed and rate without splitting
the texts again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import arrow_udf

from zonewright.llm.common import small_batches, whole_rows

#: Code points by which a segment's line may miss a boundary. With two more for rounding, a residual fits a byte.
ERROR = 125

#: Slopes are integers: this many bits stand after the point. A segment has as many boundaries at most as these bits count.
SLOPE_BITS = 20

#: Boundaries that are first tried for one segment.
FIRST_TRY = 1024

# The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

SEGMENT = T.StructType([T.StructField(name, T.LongType()) for name in ("first", "base", "slope")])
INDEX = T.StructType(
    [T.StructField("n", T.LongType()), T.StructField("segments", T.ArrayType(SEGMENT)), T.StructField("residuals", T.BinaryType())]
)


def boundaries(text: bytes) -> np.ndarray:
    """Code-point offsets at which tokens end, from 0 on.

    A token is a run of non-space with the spaces before it, or the spaces at the end of the text.
    """
    raw = np.frombuffer(text, np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    ends = ~space
    ends[:-1] &= space[1:]
    if len(raw):
        ends[-1] = True
    at = np.flatnonzero(ends) + 1
    if not text.isascii():
        at = np.cumsum((raw & 0xC0) != 0x80)[at - 1]
    return np.concatenate([[0], at])


def fit_segments(offsets: np.ndarray, error: int = ERROR) -> tuple[np.ndarray, np.ndarray]:
    """Segments (first rank, offset there, slope) and the residual of every boundary.

    Each segment goes on as long as one slope from its first boundary keeps within the error of all
    later ones: every boundary bounds the slope from both sides, and the segment ends where no slope is left.
    """
    segments, residuals = [], np.zeros(len(offsets), np.int64)
    start = 0
    while start < len(offsets):
        end, low, high, tried = start + 1, -np.inf, np.inf, FIRST_TRY
        last = min(len(offsets), start + (1 << SLOPE_BITS))
        while end < last:
            till = min(last, end + tried)
            run, rise = np.arange(end, till) - start, offsets[end:till] - offsets[start]
            lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
            fits = len(run) if lows[-1] <= highs[-1] else int((lows > highs).argmax())
            if fits:
                low, high, end = lows[fits - 1], highs[fits - 1], end + fits
            if fits < len(run):
                break
            tried *= 2
        slope = int((low + high) / 2 * (1 << SLOPE_BITS)) if end > start + 1 else 0
        line = offsets[start] + (np.arange(end - start) * slope >> SLOPE_BITS)
        residuals[start:end] = offsets[start:end] - line
        segments.append((start, int(offsets[start]), slope))
        start = end
    return np.array(segments, np.int64).reshape(-1, 3), residuals


def _index_rows(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, bytes]]:
    for text in texts.cast(pa.binary()):
        offsets = boundaries(text.as_py() or b"")
        segments, residuals = fit_segments(offsets)
        yield len(offsets) - 1, segments, (residuals + 128).astype(np.uint8).tobytes()


@arrow_udf(INDEX)
def rank_index(texts: pa.Array) -> pa.Array:
    """For each whole text: the number of its tokens, the segments, and a byte for each boundary's residual."""
    rows = list(_index_rows(texts))
    flat = np.concatenate([np.zeros((0, 3), np.int64), *(s for _, s, _ in rows)])
    places = np.cumsum([0, *(len(s) for _, s, _ in rows)])
    segments = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], names=["first", "base", "slope"])
    return pa.StructArray.from_arrays(
        [
            pa.array([n for n, _, _ in rows], pa.int64()),
            pa.ListArray.from_arrays(pa.array(places, pa.int32()), segments),
            pa.array([r for _, _, r in rows], pa.binary()),
        ],
        names=["n", "segments", "residuals"],
    )


def with_index(docs: DataFrame, text: str = "text") -> DataFrame:
    """``record``, a struct of all columns, ``text`` (a null one empty) and ``index`` of each row.

    The index has ``n``, the number of tokens, and places for ranks 0 to n. An empty text has n = 0. Rows are
    independent: repeated rows and extra columns change nothing, an empty table gives an empty one, and there is no
    shuffle. The result can be stored, and cut again and again.
    """
    small_batches(docs)
    rows = whole_rows(docs, text).select("record", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("index", rank_index("text"))


def offset_of(index: str, rank: Column) -> Column:
    """Code points before the boundary of a rank from 0 to n: the line's prediction, put right by the residual."""
    segment = F.element_at(F.filter(F.col(f"{index}.segments"), lambda s: s["first"] <= rank), -1)
    line = segment["base"] + F.shiftright(segment["slope"] * (rank - segment["first"]), SLOPE_BITS)
    byte = F.substring(F.col(f"{index}.residuals"), (rank + 1).cast("int"), F.lit(1))
    return line + F.conv(F.hex(byte), 16, 10).cast("long") - 128


def _check_marks(marks: tuple[str, ...]) -> None:
    """Marks that can't be mistaken where one meets a text: no end of one is the beginning of another."""
    for a in marks:
        for b in marks:
            if not a or (a != b and a in b) or any(a[-n:] == b[:n] for n in range(1, min(len(a), len(b)))):
                raise ValueError(f"marks {a!r} and {b!r} may overlap")
    if len(set(marks)) < len(marks):
        raise ValueError("marks must differ")


def rearrange(
    indexed: DataFrame,
    key: str = "doc_id",
    seed: int = 42,
    percent: int = 50,
    suffix_first_percent: int = 80,
    marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
) -> DataFrame:
    """Adds ``form``, ``cuts`` (offsets and lengths in code points) and ``output`` to what :func:`with_index` gives.

    Four numbers from a hash of seed and key decide: two ranks to cut at, which may be equal, whether the text is
    rearranged at all (``percent`` of them), and whether its suffix comes first (``spm``, else ``psm``). A text that is
    empty or holds a mark stays as it is (``plain``, cuts null). A null key hashes as an empty one; rows with one key and one text
    are cut alike.
    """
    _check_marks(marks)
    prefix_mark, suffix_mark, middle_mark = (F.lit(m) for m in marks)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"record.`{key}`").cast("string"), F.lit(""))).cast("binary"), 256)
    drawn = indexed.withColumn("hash", digest)
    h = [F.conv(F.substring("hash", 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    text = F.col("text")
    marked = F.contains(text, prefix_mark) | F.contains(text, suffix_mark) | F.contains(text, middle_mark)
    plain = (text == "") | marked | (h[2] % 100 >= percent)
    form = F.when(plain, "plain").when(h[3] % 100 < suffix_first_percent, "spm").otherwise("psm")
    ranks = [r % (F.col("index.n") + 1) for r in h[:2]]
    drawn = drawn.withColumns({"form": form, "low": F.least(*ranks), "high": F.greatest(*ranks)})
    moved = F.col("form") != "plain"
    start, end = offset_of("index", F.col("low")), offset_of("index", F.col("high"))
    drawn = drawn.withColumns({"start": F.when(moved, start), "end": F.when(moved, end)})
    length = lambda n: n.cast("int")
    prefix = F.substring(text, F.lit(1), length(F.col("start")))
    middle = F.substring(text, length(F.col("start") + 1), length(F.col("end") - F.col("start")))
    suffix = F.substring(text, length(F.col("end") + 1), F.lit((1 << 31) - 1))
    output = (
        F.when(~moved, text)
        .when(F.col("form") == "psm", F.concat(prefix_mark, prefix, suffix_mark, suffix, middle_mark, middle))
        .otherwise(F.concat(suffix_mark, suffix, prefix_mark, prefix, middle_mark, middle))
    )
    cuts = F.when(moved, F.struct("start", "end"))
    return drawn.select("record", "text", "index", "form", cuts.alias("cuts"), output.alias("output"))


def restored(output: str, form: str, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that an output of :func:`rearrange` was made from, found by the marks alone."""
    whole = F.col(output)
    prefix_mark, suffix_mark, middle_mark = marks

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        """What stands after the first, the second and the last mark."""
        at, last = F.instr(whole, second), F.instr(whole, middle_mark)
        return (
            F.substring(whole, F.lit(len(first) + 1), at - 1 - len(first)),
            F.substring(whole, at + len(second), last - at - len(second)),
            F.substring(whole, last + len(middle_mark), F.lit((1 << 31) - 1)),
        )

    prefix, suffix, middle = parts(prefix_mark, suffix_mark)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(suffix_mark, prefix_mark)
    spm = F.concat(prefix, middle, suffix)
    return F.when(F.col(form) == "plain", whole).when(F.col(form) == "psm", psm).otherwise(spm)
