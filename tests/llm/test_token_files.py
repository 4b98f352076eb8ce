"""Token-id files against the tokenizer library, and their format against a plain zstandard reader."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SMALL
from zonewright.llm import queries, token_files

END = queries.END_ID


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(queries.WORD_BPE)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def brute(rows, library):
    """(key, n_tokens, ids) in order, with the ids before; equal keys in any order."""
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library(text), END]
        out.append((key, start, len(ids), ids))
        start += len(ids)
    return out


def ids_of(row):
    return np.frombuffer(row.ids, "<u4").tolist()


def written(spark, df, tmp_path, **how):
    token_files.write(df, queries.WORD_BPE, f"file://{tmp_path}/out", END, **how)
    return f"file://{tmp_path}/out"


TEXTS = [
    "It's  the   end\tof\nthe line.\r\n",
    "",
    None,
    "   \n ",
    "école ÉCOLE İstanbul ΣΑΣ 字字 \U0001f600\U0001f600",
    "a b c\u0085d\x1ce​f",
    "x <|endoftext|>y<|startoftext|> z <|END|>",
    " ́mark after a space, ́ ́",
    "0123456789 " * 40,
    "don't we'll they've I'm he'd 'S 'LL",
    "w" * 5000,
    "nul\x00byte ﻿ bom",
]


def numbers(parts):
    return [np.frombuffer(p, "<u4").tolist() for p in parts]


def test_words_equal_whole_texts(library):
    words = token_files.load(queries.WORD_BPE)
    assert words.by_word
    rng = random.Random(5)
    letters = "ab \t\né́'sS1　İ.<|>"
    texts = TEXTS + ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(500)]
    plain = [chr(c) for c in (*range(0x20, 0x7F), *range(0xC0, 0x100))] * 2 + ["'re", "'ll", "'S", " ", "\n", "£", "²", "ẖ", "H̱", "ﬁ"]
    texts += ["".join(rng.choices(plain, k=rng.randint(1, 80))) for _ in range(1500)]
    assert numbers(words.encode(pa.array(texts), END)) == [[*library(t), END] for t in texts]


def test_other_vocabularies_get_whole_texts():
    words = token_files.load(queries.BYTE_BPE)
    assert not words.by_word
    whole = Tokenizer.from_file(queries.BYTE_BPE)
    expected = [whole.encode(t, add_special_tokens=False).ids + [7] for t in ("a b", "", " c")]
    assert numbers(words.encode(pa.array(["a b", None, " c"]), 7)) == expected


def test_edge_rows(spark, docs, tmp_path, library):
    rows = list(enumerate(TEXTS, 10)) + [(None, "no key"), (3, "same key"), (3, "same key too"), (3, "same key"), (-5, "first")]
    folder = written(spark, docs(rows), tmp_path)
    out = sorted(token_files.read(spark, folder).collect(), key=lambda r: r.start)
    expected = brute(rows, library)
    assert [r.key for r in out] == [e[0] for e in expected]
    assert sorted(map(ids_of, out)) == sorted(e[3] for e in expected)
    lengths = [r.n_tokens for r in out]
    assert [r.start for r in out] == np.cumsum([0, *lengths[:-1]]).tolist()
    assert [ids_of(r) for r in out if r.key is not None and r.key >= 10] == [e[3] for e in expected if e[0] is not None and e[0] >= 10]
    three = token_files.lookup(spark, folder, spark.createDataFrame([(3,), (99,), (None,), (3,), (12,)], "k long")).collect()
    assert sorted((r.key, r.start, ids_of(r)) for r in three) == sorted((r.key, r.start, ids_of(r)) for r in out if r.key in (3, 12))


def test_empty_table(spark, docs, tmp_path):
    folder = written(spark, docs([]), tmp_path)
    assert token_files.read(spark, folder).collect() == []
    assert token_files.lookup(spark, folder, spark.createDataFrame([(1,)], "k long")).collect() == []


def test_long_texts_many_frames_and_files(spark, docs, tmp_path, library, monkeypatch):
    monkeypatch.setattr(token_files, "FILES_PER_STEP", 3)
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "x9", "!"], k=rng.choice([0, 5, 50, 900])))) for i in range(120)]
    folder = written(spark, docs(rows).repartition(5), tmp_path, frame_ids=50, file_bytes=500)
    assert spark.read.parquet(f"{folder}/files").count() > 20
    expected = [tuple(e) for e in brute(rows, library)]
    out = token_files.read(spark, folder, read_bytes=700).collect()
    assert sorted((r.key, r.start, r.n_tokens, ids_of(r)) for r in out) == expected
    found = token_files.lookup(spark, folder, spark.range(0, 120, 7)).collect()
    assert sorted((r.key, r.start, r.n_tokens, ids_of(r)) for r in found) == expected[::7]


def test_a_key_with_most_rows_has_several_ranges(spark, docs, tmp_path):
    rows = [(7, "copy of one text")] * 900 + [(i, f"text {i}") for i in range(100, 200)]
    stored = f"file://{tmp_path}/in"
    docs(rows).write.parquet(stored)
    folder = written(spark, spark.read.parquet(stored), tmp_path)
    sizes = [r.n_documents for r in spark.read.parquet(f"{folder}/files").collect()]
    assert sum(sizes) == 1000 and max(sizes) < 500
    assert token_files.read(spark, folder).where("key = 7").count() == 900


def test_files_are_plain_zstandard(spark, docs, tmp_path, library):
    rows = [(i, f"text number {i}") for i in range(50)]
    folder = written(spark, docs(rows).coalesce(1), tmp_path)
    files = [r.file for r in spark.read.parquet(f"{folder}/files").orderBy("part", "file_of_part").collect()]
    ids = []
    for name in files:
        with open(tmp_path / "out" / "data" / name, "rb") as file:
            raw = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
        ids += np.frombuffer(raw, "<u4").tolist()
    assert ids == [t for e in brute(rows, library) for t in e[3]]


def test_only_the_wanted_frames_are_read(spark, docs, tmp_path, monkeypatch):
    folder = written(spark, docs([(i, f"text number {i}") for i in range(50)]).coalesce(1), tmp_path)
    name = spark.read.parquet(f"{folder}/files").first().file
    reader = token_files.FileReader(f"{folder}/data", name)
    asked = []
    at = reader._at
    reader._at = lambda start, size: asked.append(size) or at(start, size)
    reader.frames(1, 1)
    assert asked == [reader.compressed[1]]


def test_a_damaged_frame_is_an_error_and_spoils_no_other(spark, docs, tmp_path):
    folder = written(spark, docs([(i, f"text number {i}") for i in range(20)]).coalesce(1), tmp_path)
    row = spark.read.parquet(f"{folder}/directory").where("key = 4").first()
    reader = token_files.FileReader(f"{folder}/data", row.file)
    path = tmp_path / "out" / "data" / row.file
    blob = bytearray(path.read_bytes())
    blob[int(reader.starts[row.first_frame] + reader.compressed[row.first_frame]) - 2] ^= 1
    path.write_bytes(blob)
    with pytest.raises(Exception, match="damaged|Data corruption|decompress"):
        token_files.lookup(spark, folder, spark.range(4, 5)).collect()
    others = spark.read.parquet(f"{folder}/directory").where("key <> 4").select("key")
    assert token_files.lookup(spark, folder, others).count() == 19


def test_query(spark, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    out = queries.op11_token_files(spark, SMALL).collect()
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    expected = [(k, start, n, crc(ids)) for k, start, n, ids in brute(rows, library)]
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in out) == expected


def test_other_key_types(spark, tmp_path):
    df = spark.createDataFrame([("b", "two"), ("a", "one"), (None, "none")], "name string, body string")
    folder = written(spark, df, tmp_path, key="name", text="body")
    out = token_files.read(spark, folder).orderBy("start").select("key", F.length("ids").alias("size")).collect()
    assert [tuple(r) for r in out] == [(None, 8), ("a", 8), ("b", 8)]
