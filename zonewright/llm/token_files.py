"""Token-id files: independent zstandard frames with a trailing seek table and checksums.

A file is a series of zstandard frames that hold ids as little-endian unsigned 32-bit
integers. Each document begins a frame of its own, a long one takes several, so a
reader decompresses only what it asks for. Two skippable frames end the file: a
directory of the documents, and the seek table of zstandard's seekable format with
the sizes and a checksum of every frame. Any zstandard tool reads a file as one
stream of ids.
"""

from __future__ import annotations

import io
import json
import math
import posixpath
import re
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from zonewright.llm.common import small_batches

#: Bytes of texts that a writing task gets, about, and compressed bytes after which it begins another file.
PART_BYTES, FILE_BYTES = 256 << 20, 256 << 20

#: Ids of one frame at most.
FRAME_IDS = 1 << 18

#: Decompressed bytes that a reader hands on at once, about.
READ_BYTES = 8 << 20

#: Pieces of words whose ids a worker remembers, over its tasks, before it starts afresh (about 60 MB), and the longest of them.
REMEMBERED, REMEMBERED_CHARS = 300_000, 64

#: Files whose places are added up in one step.
FILES_PER_STEP = 4096

# The format's numbers.
SKIPPABLE = 0x184D2A50
SEEK_TABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80

_FOOTER = struct.Struct("<IBI")
_SKIP = struct.Struct("<II")


# The pattern of a vocabulary that drops white space, and the same one for the letters below.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|\n|[^a-z0-9ß-öø-ÿ\n]+")

#: Words of which it is plain what becomes of them: of printable ASCII and Latin letters that no normalising changes.
#: Added tokens begin with "<".
PLAIN = "^[!-;=-~À-ÖØ-öø-ÿ]*$"

#: Stands for the end of a word among ids.
LINE_END = 0xFFFFFFFF


def _byte_letters() -> dict[int, str]:
    """What byte-level vocabularies write for the plain letters beyond ASCII: a character for each byte."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letter = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in set(own))}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class _Pieces(dict):
    """Ids of pieces of words, from the library's model."""

    def __init__(self, model):
        super().__init__()
        self.model, self.letters = model, _byte_letters()

    def __missing__(self, piece: str) -> bytes:
        tokens = self.model.tokenize(piece if piece.isascii() else piece.translate(self.letters))
        ids = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        if len(piece) <= REMEMBERED_CHARS:
            self[piece] = ids
        return ids


class WordIds:
    """Ids of whole texts, by the library, which sees every distinct word of a batch, or piece of one, once.

    That equals encoding whole texts where no token and no normalising step reaches
    across white space; a vocabulary that isn't known to be of that kind gets whole texts. Words of plain
    characters are cut into pieces here and merged by the library's model, others go through all of the library.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_word = _keeps_to_words(spec)
        self.known = _Pieces(self.tokenizer.model)

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words, in a row, and how many each has. All are cut and looked up in one go, with a line end after each."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self.known["\n"] = struct.pack("<I", LINE_END)
        lines = "\n".join([*words.to_pylist(), ""]).lower()
        ids = np.frombuffer(b"".join(map(self.known.__getitem__, PIECES.findall(lines))), "<u4")
        ends = np.flatnonzero(ids == LINE_END)
        return ids[ids != LINE_END], np.diff(ends, prepend=-1) - 1

    def _words(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Ids of the words as binary values, and the place of each word's."""
        plain = pc.match_substring_regex(words, PLAIN).to_numpy(zero_copy_only=False)
        ids, sizes = self._plain(words.filter(pa.array(plain)))
        others = self._library(words.filter(pa.array(~plain)).to_pylist())
        sizes = np.concatenate([[0], 4 * sizes, [len(x) for x in others]]).astype(np.int64)
        data = pa.py_buffer(ids.tobytes() + b"".join(others))
        values = pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(np.cumsum(sizes)), data])
        place = np.empty(len(words), np.int64)
        place[np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])] = np.arange(len(words))
        return values, place

    def encode(self, texts: pa.Array, end_id: int) -> list[bytes]:
        """The ids of each text, followed by the end id, as little-endian unsigned 32-bit integers."""
        texts, end = texts.fill_null(""), struct.pack("<I", end_id)
        if not self.by_word:
            return [ids + end for ids in self._library(texts.to_pylist())]
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        values, place = self._words(coded.dictionary)
        # the ids of all words stand one after another, so a text's are one slice
        taken = values.take(pa.array(place[coded.indices.to_numpy()]))
        _, offsets, data = taken.buffers()
        starts = np.frombuffer(offsets, np.int64, len(taken) + 1)[split.offsets.to_numpy() - split.offsets[0].as_py()].tolist()
        ids = memoryview(data) if data else b""
        return [bytes(ids[a:b]) + end for a, b in zip(starts, starts[1:], strict=False)]


def _keeps_to_words(spec: dict) -> bool:
    """Whether a vocabulary drops white space, splits at it, and merges byte by byte within words."""
    normalizer, split, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec["model"]
    steps = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
    pieces = [
        {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]
    added = spec["added_tokens"]
    alone = not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["content"].split() != [t["content"]] for t in added)
    alone = alone and all(t["content"].startswith("<") for t in added)
    same = normalizer.get("normalizers") == steps and split.get("pretokenizers") == pieces
    return alone and same and model["type"] == "BPE" and not model.get("dropout")


@lru_cache(2)
def load(path: str) -> WordIds:
    return WordIds(path)


def _file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    """Any store that Arrow knows; a folder without a scheme is a mounted one."""
    if "://" in folder or folder.startswith("file:"):
        scheme, rest = folder.split(":", 1)
        return pafs.FileSystem.from_uri(f"{scheme}://{rest}" if scheme == "file" and not rest.startswith("//") else folder)
    return pafs.LocalFileSystem(), folder


class _FileWriter:
    """One file; the directory and the seek table are kept until it is closed."""

    def __init__(self, folder: str, key: pa.DataType, frame_ids: int):
        self.files, base = _file_system(folder)
        self.name = f"tokens-{uuid.uuid4().hex}.zst"  # of this attempt, so none writes into another's file
        self.files.create_dir(base, recursive=True)
        self.stream = self.files.open_output_stream(posixpath.join(base, self.name), compression=None)
        self.compressor = zstandard.ZstdCompressor(level=3, write_content_size=True)
        self.key, self.sizes, self.sums, self.bytes, self.ids = key, [], [], 0, 0
        self.keys, self.tokens, self.frames, self.frame_ids = [], [], [], frame_ids

    def add(self, key: pa.Array, ids: bytes) -> tuple[int, int, int]:
        """First frame, frames and ids of the file before this document."""
        first, start = len(self.sizes), self.ids
        for at in range(0, len(ids), 4 * self.frame_ids):
            raw = ids[at : at + 4 * self.frame_ids]
            frame = self.compressor.compress(raw)
            self.stream.write(frame)
            self.sizes.append((len(frame), len(raw)))
            self.sums.append(xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF)
            self.bytes += len(frame)
        self.ids += len(ids) // 4
        self.keys.append(key)
        self.tokens.append(len(ids) // 4)
        self.frames.append(len(self.sizes) - first)
        return first, self.frames[-1], start

    def close(self) -> None:
        sink = io.BytesIO()
        columns = {"key": pa.chunked_array(self.keys, self.key), "n_tokens": pa.array(self.tokens, pa.int64()), "n_frames": pa.array(self.frames, pa.int32())}
        directory = pa.table(columns).combine_chunks()
        with pa.ipc.new_stream(sink, directory.schema) as out:
            out.write_table(directory)
        blob = zstandard.ZstdCompressor(level=3).compress(sink.getvalue())
        self.stream.write(_SKIP.pack(SKIPPABLE, len(blob)) + blob)
        table = np.column_stack([np.array(self.sizes, "<u4").reshape(-1, 2), np.array(self.sums, "<u4")]).astype("<u4").tobytes()
        footer = _FOOTER.pack(len(self.sizes), CHECKSUMS, SEEKABLE)
        self.stream.write(_SKIP.pack(SEEK_TABLE, len(table) + len(footer)) + table + footer)
        self.stream.close()


class FileReader:
    """Frames of one file by number, found through its seek table and checked."""

    def __init__(self, folder: str, name: str):
        files, base = _file_system(folder)
        self.name = name
        self.file = files.open_input_file(posixpath.join(base, name))
        size = self.file.size()
        n, flags, magic = _FOOTER.unpack(self._at(size - _FOOTER.size, _FOOTER.size))
        if magic != SEEKABLE or not flags & CHECKSUMS:
            raise ValueError(f"{name} has no seek table with checksums")
        table = np.frombuffer(self._at(size - _FOOTER.size - 12 * n, 12 * n), "<u4").reshape(-1, 3)
        self.compressed, self.raw, self.sums = (table[:, i].astype(np.int64) for i in range(3))
        self.starts = np.cumsum(self.compressed) - self.compressed
        self.decompressor = zstandard.ZstdDecompressor()
        self.n_frames = n

    def _at(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def directory(self) -> pa.Table:
        """key, n_tokens and n_frames of the documents, in their order."""
        start = int(self.compressed.sum())
        magic, size = _SKIP.unpack(self._at(start, _SKIP.size))
        if magic != SKIPPABLE:
            raise ValueError(f"{self.name} has no directory")
        return pa.ipc.open_stream(self.decompressor.decompress(self._at(start + _SKIP.size, size))).read_all()

    def frames(self, first: int, count: int) -> bytes:
        """Ids of some frames that follow each other, in one read."""
        blob = self._at(int(self.starts[first]), int(self.compressed[first : first + count].sum()))
        out, at = [], 0
        for i in range(first, first + count):
            raw = self.decompressor.decompress(blob[at : at + self.compressed[i]])
            if len(raw) != self.raw[i] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[i]:
                raise ValueError(f"{self.name}: frame {i} is damaged")
            out.append(raw)
            at += self.compressed[i]
        return b"".join(out)

    def close(self) -> None:
        self.file.close()


def write(
    docs: DataFrame,
    path: str,
    folder: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    frame_ids: int = FRAME_IDS,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Writes the ids of every whole text to files below ``folder``, documents in ascending order of ``key``.

    Each document's ids are followed by ``end_id``. A null text counts as empty and
    has the end id only; rows without a key come first; rows with one key are ordered
    by a hash of their text, and repeated rows are each written. Other columns are not
    read. An empty table gives no files. ``docs`` should be stored, not computed, as
    repeated rows are dealt by their place in it.

    Texts are dealt to ranges of (key, hash, place), so a key with a third of the rows
    has several ranges. Each range is one task's files; a task that is run again writes
    files of other names, and only those of the attempt that counts come into the
    stored directory: ``directory`` (one row a document) and ``files`` (one a file),
    both Parquet, below ``folder`` beside ``data``. ``folder`` and ``path`` must be
    readable on the executors.
    """
    small_batches(docs)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    order = [F.asc_nulls_first("key"), "hash", "place"]
    rows = rows.select("key", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("place"), "text")
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_bytes / PART_BYTES))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("key", F.spark_partition_id().alias("part"), "text")
    schema = T.StructType(
        [
            T.StructField("key", rows.schema["key"].dataType),
            T.StructField("part", T.IntegerType()),
            T.StructField("file_of_part", T.IntegerType()),
            T.StructField("file", T.StringType()),
            T.StructField("first_frame", T.IntegerType()),
            T.StructField("n_frames", T.IntegerType()),
            T.StructField("start_in_file", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )
    arrow, data = to_arrow_schema(schema), f"{folder}/data"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, out, n_files = load(path), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0)
            places = []
            for i, ids in enumerate(words.encode(batch.column(2), end_id)):
                if out is None:
                    out, n_files = _FileWriter(data, keys.type, frame_ids), n_files + 1
                first, frames, start = out.add(keys.slice(i, 1), ids)
                places.append((n_files - 1, out.name, first, frames, start, len(ids) // 4))
                if out.bytes >= file_bytes:
                    out.close()
                    out = None
            made = [pa.array(x, f.type) for x, f in zip(zip(*places, strict=True), list(arrow)[2:], strict=True)]
            yield pa.RecordBatch.from_arrays([keys, batch.column(1), *made], schema=arrow)
        if out is not None:
            out.close()
        pa.default_memory_pool().release_unused()

    ranged.mapInArrow(run, schema).write.parquet(f"{folder}/directory")
    _files(spark.read.schema(schema).parquet(f"{folder}/directory")).write.parquet(f"{folder}/files")


def _files(directory: DataFrame) -> DataFrame:
    """One row a file: its documents, its ids, and ``start``, the ids of all files before it.

    Starts add up over steps of files first, so that no task gets all files.
    """
    files = directory.groupBy("part", "file_of_part", "file").agg(F.count(F.lit(1)).alias("n_documents"), F.sum("n_tokens").alias("n_tokens"))
    step = F.floor(F.col("part") / FILES_PER_STEP).alias("step")
    files = files.withColumn("step", step)
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = files.groupBy("step").agg(F.sum("n_tokens").alias("n"))
    steps = sums.select("step", F.coalesce(F.sum("n").over(before(Window.orderBy("step"))), F.lit(0)).alias("before"))
    earlier = F.coalesce(F.sum("n_tokens").over(before(Window.partitionBy("step").orderBy("part", "file_of_part"))), F.lit(0))
    return files.withColumn("earlier", earlier).join(steps, "step").select(
        "part", "file_of_part", "file", "n_documents", "n_tokens", (F.col("before") + F.col("earlier")).alias("start")
    )


def _read_schema(directory: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("key", directory.schema["key"].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )


def _batches(rows: Iterator[tuple], schema: pa.Schema, read_bytes: int = READ_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows whose last value is binary, in batches of about ``read_bytes``."""
    some, size = [], 0

    def batch():
        arrays = [pa.array(x, f.type) for x, f in zip(zip(*some, strict=True), schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for row in rows:
        some.append(row)
        size += len(row[-1])
        if size >= read_bytes or len(some) >= 10_000:
            yield batch()
            some, size = [], 0
    if some:
        yield batch()


def read(spark: SparkSession, folder: str, read_bytes: int = READ_BYTES) -> DataFrame:
    """All documents, from the files alone: key, start, n_tokens, ids (with the end id).

    ``start`` counts the ids of all documents before. Each file is read by one task,
    in pieces. A frame whose checksum differs is an error that names file and frame.
    """
    files = spark.read.parquet(f"{folder}/files").select("file", "start")
    schema, data = _read_schema(spark.read.parquet(f"{folder}/directory")), f"{folder}/data"
    arrow = to_arrow_schema(schema)

    def documents(name: str, start: int) -> Iterator[tuple]:
        reader = FileReader(data, name)
        held = reader.directory()
        frame, i, n_tokens, counts = 0, 0, held["n_tokens"].to_pylist(), held["n_frames"].to_pylist()
        raw = np.cumsum(reader.raw)
        while i < len(counts):
            # some documents at a time
            till, frames, begun = i, 0, raw[frame - 1] if frame else 0
            while till < len(counts) and (till == i or raw[frame + frames + counts[till] - 1] - begun <= read_bytes):
                frames, till = frames + counts[till], till + 1
            blob, at = reader.frames(frame, frames), 0
            for key, n in zip(held["key"].slice(i, till - i).to_pylist(), n_tokens[i:till], strict=True):
                yield key, start, n, blob[at : at + 4 * n]
                at, start = at + 4 * n, start + n
            frame, i = frame + frames, till
        reader.close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield from _batches(documents(name, start), arrow, read_bytes)

    tasks = max(1, min(files.count(), 4 * spark.sparkContext.defaultParallelism))
    return files.repartition(tasks).mapInArrow(run, schema)


def lookup(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """As :func:`read`, for the documents whose key is in the only column of ``keys``; only their frames are read.

    A key with several documents gives them all, repeated and unknown keys and null change nothing.
    """
    directory = spark.read.parquet(f"{folder}/directory")
    files = spark.read.parquet(f"{folder}/files").select("file", F.col("start").alias("before"))
    asked = keys.toDF("key").where("key IS NOT NULL").distinct()
    found = directory.join(asked, "key").join(files, "file")
    found = found.select("key", "file", "first_frame", "n_frames", (F.col("before") + F.col("start_in_file")).alias("start"), "n_tokens")
    # a file with very many of the documents isn't one task's work
    spread = found.repartition(F.col("file"), F.floor(F.col("first_frame") / 4096)).sortWithinPartitions("file", "first_frame")
    schema, data = _read_schema(directory), f"{folder}/data"
    arrow = to_arrow_schema(schema)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        reader = None
        for batch in batches:
            for row in batch.to_pylist():
                if reader is None or reader.name != row["file"]:
                    if reader:
                        reader.close()
                    reader = FileReader(data, row["file"])
                yield row["key"], row["start"], row["n_tokens"], reader.frames(row["first_frame"], row["n_frames"])
        if reader:
            reader.close()

    return spread.mapInArrow(lambda batches: _batches(documents(batches), arrow), schema)
