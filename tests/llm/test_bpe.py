"""The encoder and decoder against the tokenizers library."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from zonewright.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids(text):
    return np.frombuffer(bpe.load(PATH).encode(text), "<u4").tolist()


def expected(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


PIECES = ["a", "A", " ", "  ", "\n", "the", "ing", "<|endoftext|>", "'s", "'ll", "é", "ß", "漢", "😀", "1", "--", "aaaa", "\t", "\x85", "\x1c", "　"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40).map("".join) | st.text(max_size=80))
def test_same_ids_and_text_as_the_library(text):
    own = bpe.load(PATH).encode(text)
    assert np.frombuffer(own, "<u4").tolist() == expected(text)
    assert bpe.load_offsets(PATH).decode(own) == LIBRARY.decode(expected(text), skip_special_tokens=False) == text


def test_every_character_class_splits_as_in_the_library():
    everything = "".join(chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000)
    for i in range(0, len(everything), 400):
        text = "a" + "b1 ".join(everything[i : i + 400])
        assert ids(text) == expected(text)


@pytest.mark.parametrize("text", ["ab" * 30_000, "a" * 20_000, " " * 5000, "aaab" * 5000])
def test_a_huge_pre_token(text):
    assert ids(text) == expected(text)


def test_decoding_replaces_what_is_no_utf8():
    parts = [i for i in range(256, 50_256) if "�" in LIBRARY.decode([i])][:20]
    for i in parts:
        assert bpe.load_offsets(PATH).decode(np.array([i], "<u4").tobytes()) == LIBRARY.decode([i], skip_special_tokens=False)


def test_unfitting_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.ByteBpe(public_tokenizers.path("word_bpe_49k.json"))


def test_null_empty_repeated_and_clashing(docs):
    rows = [(1, None), (2, ""), (3, "the the"), (3, "the the"), (None, "x")]
    encoded = bpe.encode(docs(rows).withColumnRenamed("kept", "ids"), PATH, ["doc_id"])
    found = {(r.doc_id, r.n_tokens, bytes(r.ids)) for r in encoded.collect()}
    assert (1, 0, b"") in found and (2, 0, b"") in found and (3, 2, np.array(expected("the the"), "<u4").tobytes()) in found
    assert encoded.count() == 5
    decoded = bpe.decode(encoded, PATH, ["doc_id"]).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in decoded) == [(0, "x"), (1, ""), (2, ""), (3, "the the"), (3, "the the")]
    assert bpe.encode(docs([]), PATH, ["doc_id"]).count() == 0


def test_query_digests(spark):
    from tests.conftest import SMALL

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in queries.op2_bpe(spark, SMALL).collect():
        own = expected(texts[r.doc_id])
        assert r.n_tokens == len(own)
        assert r.ids_sha256 == hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
