"""JSON arrays of documents, read and written by many tasks.

A splittable text scan cuts an array at every closing brace, wherever it stands. Which of
them end a document depends on all that comes before: how deep the nesting is,
and whether a string is open. Both are sums, so they need no single reader: each
block of the file reports its change for either kind of start, a running sum over the blocks, one
row each, fixes how every block starts, and a second scan cuts the documents where they stand.
Only what lies across the edge of a block is shuffled. A compressed file is one block, so it needs neither the
first scan nor the starts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

#: Bytes of documents in one written array, about.
ARRAY_BYTES = 128 << 20

#: Lines of a written array: each has as many documents as fill its part of the bytes, one at least.
ARRAY_LINES = 32

#: Fastest level of gzip and deflate: the default one takes several times as long as all else that a task writes with it.
FAST = {"zlib.compress.level": "BEST_SPEED"}

BLOCK = ("file", "block")

# Files that a scan never cuts. The condition is one on whole files, so those it leaves out are not opened.
PACKED = "_metadata.file_name LIKE '%.gz'"

_QUOTE, _BACKSLASH, _CLOSE = b'"\\}'
_CHANGE = np.zeros(256, np.int64)
_CHANGE[list(b"{[")], _CHANGE[list(b"}]")] = 1, -1


def _pieces(spark: SparkSession, path: str, files: str, *place: str) -> DataFrame:
    """What lies between closing braces, in the file's order within a task, with its file. The last of a file gets a brace too."""
    text = spark.read.option("lineSep", "}").text(path).where(files)
    return text.selectExpr("_metadata.file_path AS file", *place, "concat(value, '}') AS value")


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, np.ndarray]]:
    """The rows of a batch by block, in order: the block, the place of its first row, and the bytes of its pieces.

    Rows of files that are never cut come without a block; theirs is 0.
    """
    value = batch.column(batch.schema.get_field_index("value")).cast(pa.large_binary())
    offsets = np.frombuffer(value.buffers()[1], np.int64)[value.offset : value.offset + len(value) + 1]
    raw = np.frombuffer(value.buffers()[2], np.uint8)
    if not len(value):
        return
    places = [batch.column(batch.schema.get_field_index(name)) for name in BLOCK if name in batch.schema.names]
    changes = np.zeros(len(value) - 1, bool)
    for place in places:
        if place[0] != place[-1]:  # a task reads a block in one go, so else it is the same all through
            changes |= np.diff(np.asarray(place.dictionary_encode().indices)) != 0
    edges = np.flatnonzero(changes) + 1
    for start, end in zip([0, *edges], [*edges, len(value)], strict=True):
        block = [place[int(start)].as_py() for place in places]
        yield (*block, 0)[:2], int(start), raw[offsets[start] : offsets[end]]


def _texts(raw: bytes, offsets: Sequence[int]) -> pa.Array:
    """What stands in some bytes between each two offsets."""
    buffers = [None, pa.py_buffer(np.array(offsets, np.int32)), pa.py_buffer(raw)]
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1, buffers)


def _marks(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and bytes of the quotes, braces and brackets that no backslash escapes, bars among them."""
    # with the bit of small letters set, the brackets are braces, and a backslash is the bar between these two
    at = np.flatnonzero(((raw | 32) - ord("{") <= 2) | (raw == _QUOTE))
    mark = raw[at]
    escapes = mark == _BACKSLASH
    if escapes.any():
        back, at = at[escapes], at[~escapes]
        mark = mark[~escapes]
        first = np.maximum.accumulate(np.where(np.diff(back, prepend=-2) != 1, np.arange(len(back)), 0))
        odd = back[(np.arange(len(back)) - first) % 2 == 0]  # those that another one doesn't escape
        free = ~np.isin(at - 1, odd)
        at, mark = at[free], mark[free]
    return at, mark


def _runs(mark: np.ndarray, quoted: int, depth: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Which marks close a brace outside of strings, and the depth after each of them. Then whether a string is open at the end, and the depth there."""
    quote = mark == _QUOTE
    flips = np.cumsum(quote, dtype=np.uint8)  # an overflow keeps them odd or even
    outside = np.flatnonzero(~quote & ((flips & 1) == quoted))
    inner = mark[outside]
    depths = depth + np.cumsum(_CHANGE[inner])
    closes = inner == _CLOSE
    return outside[closes], depths[closes], (quoted + int(flips[-1] if len(flips) else 0)) % 2, int(depths[-1]) if len(depths) else depth


_KINDS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("quoted", "run", "closings")]))
_SUMMARY = T.StructType(
    [
        T.StructField("file", T.StringType()),
        *[T.StructField(n, T.LongType()) for n in ("block", "flipped", "run0", "run1")],
        T.StructField("kinds", _KINDS),
    ]
)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block, for either kind of start: the changes of quoting and depth, and how many braces close to each depth."""
    schema = to_arrow_schema(_SUMMARY)
    here, state, closings = None, [], Counter()

    def summary() -> pa.RecordBatch:
        kinds = [{"quoted": k, "run": run, "closings": n} for (k, run), n in closings.items()]
        row = {"file": here[0], "block": here[1], "flipped": state[0][0], "run0": state[0][1], "run1": state[1][1], "kinds": kinds}
        return pa.RecordBatch.from_pylist([row], schema=schema)

    for batch in batches:
        for block, _, raw in _stretches(batch):
            if block != here:
                if here:
                    yield summary()
                here, state, closings = block, [(0, 0), (1, 0)], Counter()
            _, mark = _marks(raw)
            for k, (quoted, depth) in enumerate(state):
                _, depths, *state[k] = _runs(mark, quoted, depth)
                runs, counts = np.unique(depths, return_counts=True)
                closings.update({(k, int(run)): int(n) for run, n in zip(runs, counts, strict=True)})
    if here:
        yield summary()


def _block_starts(pieces: DataFrame) -> DataFrame:
    """Per block: whether it starts in a string, how deep, and how many documents ended before it.

    A document ends where a brace outside of strings closes to depth one. How many do in a block is looked up among the
    depths that its braces close to, counted for either kind of start. One row a block goes into the sums over a file.
    """
    counted = F.transform("kinds", lambda k: F.struct(F.struct(k["quoted"], k["run"]), k["closings"]))
    blocks = pieces.select(*BLOCK, "value").mapInArrow(_summaries, _SUMMARY).withColumn("closings", F.map_from_entries(counted))
    file = Window.partitionBy("file")
    earlier = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def before(column: str) -> Column:
        return F.coalesce(F.sum(column).over(earlier), F.lit(0))

    blocks = blocks.withColumn("quoted", before("flipped") % 2)
    blocks = blocks.withColumn("change", F.when(F.col("quoted") == 0, F.col("run0")).otherwise(F.col("run1")))
    blocks = blocks.withColumn("depth", before("change"))
    to_one = F.struct(F.col("quoted"), (1 - F.col("depth")).alias("run"))
    blocks = blocks.withColumn("ends", F.coalesce(F.try_element_at("closings", to_one), F.lit(0)))
    # the last piece of a file has no brace after it, which was counted all the same
    sound = (F.sum("change").over(file) == -1) & (F.sum("flipped").over(file) % 2 == 0)
    return blocks.select(*BLOCK, "quoted", "depth", before("ends").alias("documents"), sound.alias("sound"))


# How a block starts, and a file.
STARTS = {"several": False, "quoted": 0, "depth": 0, "documents": 0, "sound": True}

_CUT = T.StructType(
    [
        T.StructField("file", T.StringType()),
        *[T.StructField(n, T.LongType()) for n in ("number", "block", "place", "ends")],
        T.StructField("sound", T.BooleanType()),
        T.StructField("text", T.StringType()),
    ]
)


def _cut(edges: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cuts documents out of blocks; ``ends`` is 1 where a text ends one. Without their starts they are whole files.

    What lies before the first end in a block of several and after the last one belongs to documents that other blocks
    share: with ``edges`` only that is given, else only the rest. What is left at the end of a file has no end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(_CUT)
        here, several, quoted, depth, number, seen, place, sound, left = None, False, 0, 0, 0, 0, 0, True, []

        def rows(texts: pa.Array, numbers: np.ndarray, ends: int, sound: bool) -> pa.RecordBatch:
            n = len(texts)
            same = [pa.repeat(pa.scalar(x, schema.field(name).type), n) for name, x in (("file", here[0]), ("block", here[1]), ("place", place), ("ends", ends), ("sound", sound))]
            return pa.RecordBatch.from_arrays([same[0], pa.array(numbers, pa.int64()), *same[1:], texts], schema=schema)

        def one(text: bytes, ends: int, sound: bool) -> pa.RecordBatch:
            return rows(_texts(text, [0, len(text)]), np.array([number]), ends, sound)

        def rest() -> Iterator[pa.RecordBatch]:
            """What a block leaves after its last end: of a whole file the end, else a part of a document."""
            text, fits = b"".join(left), sound if several else (quoted, depth) == (0, -1)
            if here and several == edges and (text or not fits):
                yield one(text, 0, fits)

        for batch in batches:
            start_of = [batch.column(batch.schema.get_field_index(c)) for c in STARTS if c in batch.schema.names]
            for block, row, raw in _stretches(batch):
                if block != here:
                    yield from rest()
                    several, quoted, depth, number, sound = (c[row].as_py() for c in start_of) if start_of else STARTS.values()
                    here, seen, place, left = block, 0, 0, []
                at, mark = _marks(raw)
                closes, depths, quoted, depth = _runs(mark, quoted, depth)
                ends = at[closes[depths == 1]] + 1
                if len(ends):
                    first = several and not seen  # other blocks share this one
                    if first and edges:
                        yield one(b"".join([*left, raw[: ends[0]].tobytes()]), 1, sound)
                        place += 1
                    if not edges:
                        own = 0 if not first else int(ends[0])
                        begun = [] if first else left
                        kept = ends[1:] if first else ends
                        if len(kept):
                            text = b"".join([*begun, raw[own : kept[-1]].tobytes()])
                            offsets = np.concatenate([[0], kept - own + len(text) - (int(kept[-1]) - own)])
                            yield rows(_texts(text, offsets), number + int(first) + np.arange(len(kept)), 1, sound)
                    number, seen, left = number + len(ends), seen + len(ends), []
                    raw = raw[ends[-1] :]
                if several == edges or seen:
                    left.append(raw.tobytes())
                if edges and several and not seen:  # no end so far: nothing is held back
                    yield one(b"".join(left), 0, sound)
                    place, left = place + 1, []
        yield from rest()

    return run


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Documents of JSON arrays, indented or not; one file is read by as many tasks as it has blocks.

    An array's elements are objects, with any nesting; braces, brackets, quotes and escapes
    in strings are text. An empty array or file has no documents. Anything else at
    the top, an array that breaks off, and a document that doesn't fit the schema are errors when they are
    read. Compressed files can't be cut, so one is one block.
    """
    packed = _pieces(spark, path, PACKED)
    several = "_metadata.file_block_length < _metadata.file_size AS several"
    pieces = _pieces(spark, path, f"NOT {PACKED}", "_metadata.file_block_start AS block", several)
    starts = F.broadcast(_block_starts(pieces.where("several")))
    # a broadcast join leaves the rows of a task as they come
    whole = pieces.join(starts, list(BLOCK), "left").fillna(STARTS)
    shared = pieces.where("several").join(starts, list(BLOCK))
    parts = F.sort_array(F.collect_list(F.struct("block", "place", "text")))
    joined = shared.mapInArrow(_cut(edges=True), _CUT).groupBy("file", "number").agg(
        F.max("ends").alias("ends"), F.min("sound").alias("sound"), parts.alias("parts")
    )
    joined = joined.withColumn("text", F.array_join(F.transform("parts", lambda part: part["text"]), ""))
    columns = ["file", "ends", "sound", "text"]
    cut_there = [rows.mapInArrow(_cut(edges=False), _CUT) for rows in (packed, whole)]
    documents = reduce(DataFrame.unionByName, [rows.select(columns) for rows in (*cut_there, joined)])
    text = F.col("text")
    left = F.expr("left(text, length(text) - 1)")
    rest = left.rlike(r"\A\s*(\[\s*)?\]?\s*\z")
    broken = F.raise_error(F.concat(F.col("file"), F.lit(" is no JSON array of documents")))
    is_document = F.when(~F.col("sound"), broken.cast("boolean")).when(F.col("ends") == 1, True).when(rest, False)
    body = F.ltrim(text, F.lit(" \t\n\v\f\r,["))
    parsed = F.from_json(body, T.StructType.fromDDL(schema), {"mode": "FAILFAST"})
    cut = documents.where(is_document.otherwise(broken.cast("boolean")))
    return cut.select(parsed.alias("document")).select("document.*")


def _array_lines(line_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lines of arrays, ``ARRAY_LINES`` each and fewer in a task's last: documents after documents, with the array's signs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def line(texts: list[bytes], place: int, last: bool) -> pa.RecordBatch:
            last |= place % ARRAY_LINES == ARRAY_LINES - 1
            text = (b"," if place % ARRAY_LINES else b"[") + b",\n".join(texts) + (b"]" if last else b"")
            return pa.RecordBatch.from_arrays([_texts(text, [0, len(text)])], names=["value"])

        place, texts, n_bytes = 0, [], 0
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                if n_bytes >= line_bytes:
                    yield line(texts, place, False)
                    place, texts, n_bytes = place + 1, [], 0
                texts.append(text)
                n_bytes += len(text)
        if texts:
            yield line(texts, place, True)

    return run


def write_json_arrays(documents: DataFrame, path: str, array_bytes: int = ARRAY_BYTES, compression: str = "none") -> None:
    """JSON arrays of documents, one per file; each task writes its own, and begins another when one has its bytes.

    A file is written line by line, some documents each, so no array is held in memory.
    Nothing to write gives one empty array. A compressed array is read by one task.
    """
    whole = F.to_json(F.struct(*documents.columns), {"ignoreNullFields": "false"})
    lines = documents.select(whole.alias("value")).mapInArrow(_array_lines(max(1, array_bytes // ARRAY_LINES)), "value string")
    spark, folder = documents.sparkSession, f"{path}/part=0"
    lines.write.mode("overwrite").options(**FAST).option("maxRecordsPerFile", ARRAY_LINES).option("compression", compression).text(folder)
    if spark.read.text(folder).isEmpty():
        spark.range(1).select(F.lit("[]")).write.mode("overwrite").option("compression", compression).text(folder)
