"""The pipeline: each stage's decisions against the operator's own, planted documents, and its columns."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.test_near_dedup import brute_at
from zonewright.llm import quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """What each stage gets and returns, written and read again, with planted rows."""
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    long = max((r.text for r in documents.collect() if r.text), key=len)
    words = long.split()
    near = " ".join([*words[:-1], "changed"])
    planted = [(9001, long), (9002, near), (9003, " ".join(words[:300]) + " you idiot, you stupid moron"), (9004, None), (9005, ""), (None, long), (9006, "word " * 500)]
    rows = spark.createDataFrame([(i, t, "en", "planted", 1) for i, t in planted], documents.schema)
    docs, path = documents.union(rows), tmp_path_factory.mktemp("stages")
    found = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{path}/{name}")
        found.append((docs, docs := spark.read.parquet(f"{path}/{name}")))
    return found


def ids(df):
    return sorted(r.doc_id if r.doc_id is not None else -1 for r in df.select("doc_id").collect())


def test_order_and_columns(outputs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "minhash_near_dedup", "mixing", "bpe"]
    for _, out in outputs[:-1]:
        assert out.columns == COLUMNS


def test_toxic_documents_go_and_clean_ones_stay(spark, outputs):
    before, after = outputs[0]
    assert 9003 not in ids(after) and {9001, 9002, 9004, 9005, -1} <= set(ids(after))
    clean = set(ids(spark.read.parquet(f"{SMALL}/labels.parquet").where("toxic = 0"))) & set(ids(before))
    assert len(clean - set(ids(after))) <= 0.01 * len(clean)


def test_quality_keeps_what_the_operator_keeps(outputs):
    before, after = outputs[1]
    assert ids(after) == ids(quality.judge_texts(before, ["doc_id"]).where("kept"))
    assert not {9004, 9005, 9006} & set(ids(after)) and {9001, -1} <= set(ids(after))


def test_one_document_of_each_group_stays(outputs):
    before, after = outputs[2]
    groups = brute_at([(r.doc_id, r.text) for r in before.collect() if r.doc_id is not None], corpus_pipeline.NEAR_PERCENT)
    assert [i for i in ids(after) if i >= 0] == sorted(i for i, root in groups.items() if i == root)
    assert not {9001, 9002} & set(ids(after))


def test_the_mix_repeats_and_drops_whole_rows(outputs):
    before, after = outputs[3]
    assert set(after.distinct().collect()) <= set(before.collect())
    assert ids(after) != ids(before)


def test_tokens(outputs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    before, after = outputs[4]
    texts = {r.doc_id: r.text for r in before.collect()}
    rows = after.collect()
    assert len(rows) == before.count() and all(r.round_trip for r in rows)
    for r in rows[:40]:
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids


def test_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).count() == 0


def test_near_copies_from_80_percent_go(spark):
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    base = [f"base{i}" for i in range(100)]  # 96 shingles
    cut = lambda k: " ".join(base[: 100 - k] + [f"new{k}x{i}" for i in range(k)])
    rows = [(1, cut(0)), (2, cut(9)), (3, cut(11))]  # 0.829 and 0.794 of the union with the first
    docs = spark.createDataFrame([(i, t, "en", "planted", 1) for i, t in rows], schema)
    assert ids(corpus_pipeline.near_dedup_stage(spark, docs, SMALL)) == [1, 3]


def test_near_dedup_decides_by_texts(spark):
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    a, b, c = (" ".join(f"{x}{i}" for i in range(100)) for x in "abc")
    near_a = a + " more"  # sorts after a
    rows = [(5, b, "en"), (5, near_a, "en"), (5, a, "en"), (3, b, "fr"), (3, b, "de"), (9, a, "en"), (None, c, "en"), (None, c, "en"), (None, b, "en"), (7, None, "en"), (None, "", "en")]
    kept = [(3, b, "de"), (5, a, "en"), (7, None, "en"), (None, "", "en"), (None, c, "en")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame([(i, t, x, "planted", 1) for i, t, x in order], schema).repartition(3)
        out = corpus_pipeline.near_dedup_stage(spark, docs, SMALL)
        assert out.columns == COLUMNS
        assert sorted(((r.doc_id, r.text, r.lang) for r in out.collect()), key=str) == sorted(kept, key=str)


def test_columns_may_have_the_names_that_stages_use(spark):
    schema = "doc_id long, text string, component_id long, record string, least long, kept boolean, score double, domain string, __row long"
    words = " ".join(f"word{i}" for i in range(100))
    docs = spark.createDataFrame([(i, t, 7, "r", 8, False, 0.5, "d", 9) for i, t in ((2, words), (1, words + " more"), (3, None))], schema)
    for _, stage in corpus_pipeline.STAGES[:-2]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
    assert [tuple(r)[:3] for r in corpus_pipeline.near_dedup_stage(spark, docs, SMALL).orderBy("doc_id").collect()] == [(1, words + " more", 7), (3, None, 7)]
