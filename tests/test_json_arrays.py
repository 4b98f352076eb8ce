"""JSON arrays cut into blocks against the reader that takes a whole file."""

import gzip
import json
import random

import pytest

from zonewright.sources.json_arrays import read_json_array, write_json_arrays
from zonewright.sources.readers import write_ndjson

SCHEMA = "id bigint, text string, nested struct<a: string, list: array<struct<b: bigint, c: string>>>, numbers array<bigint>"

NASTY = ['}', '{', ']', '[', '"', '\\', '\\"', '},{', '"}', '\n', '\\\\"', 'ü}', ' ', "'", ':', ',', 'x']


def document(rng, i, size=4):
    text = lambda: "".join(rng.choices(NASTY, k=rng.randint(0, size)))
    items = [{"b": rng.randint(0, 9), "c": text()} for _ in range(rng.randint(0, 3))]
    full = {"id": i, "text": text(), "nested": {"a": text(), "list": items}, "numbers": [1] * rng.randint(0, 2)}
    for name in ("text", "nested", "numbers"):
        if rng.random() < 0.1:
            full[name] = None
    return full


def whole(spark, path):
    return spark.read.schema(SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path)


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("indent", [None, 2])
def test_blocks_of_any_size_give_the_documents(spark, tmp_path, conf, indent):
    rng = random.Random(7)
    documents = [document(rng, i) for i in range(400)]
    for name, some in (("a", documents[:300]), ("b", documents[300:]), ("none", [])):
        (tmp_path / f"{name}.json").write_text(json.dumps(some, indent=indent, ensure_ascii=rng.random() < 0.5), encoding="utf-8")
    expected = rows(whole(spark, str(tmp_path)))
    assert len(expected) == 400
    for block in (113, 1021, 10**8):
        conf(spark__sql__files__maxPartitionBytes=str(block), spark__sql__files__openCostInBytes="0")
        array = read_json_array(spark, str(tmp_path), SCHEMA)
        assert array.schema == whole(spark, str(tmp_path)).schema
        assert rows(array) == expected


def test_a_document_over_many_blocks(spark, tmp_path, conf):
    rng = random.Random(3)
    documents = [document(rng, i, size=3000 if i in (2, 3, 9) else 4) for i in range(12)]
    (tmp_path / "a.json").write_text(json.dumps(documents))
    conf(spark__sql__files__maxPartitionBytes="512", spark__sql__files__openCostInBytes="0")
    array = read_json_array(spark, str(tmp_path), SCHEMA)
    assert rows(array) == rows(whole(spark, str(tmp_path)))


def test_one_file_is_several_tasks(spark, tmp_path, conf):
    (tmp_path / "a.json").write_text(json.dumps([{"id": i, "text": "x" * 50} for i in range(5000)]))
    conf(spark__sql__files__maxPartitionBytes="40000", spark__sql__files__openCostInBytes="0")
    scan = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert scan.rdd.getNumPartitions() >= 8
    assert read_json_array(spark, str(tmp_path), SCHEMA).selectExpr("sum(id)", "count(*)").first() == (12497500, 5000)


@pytest.mark.parametrize(
    "text",
    [
        '[{"id": 1}, {"id": 2',
        '[{"id": 1}, {"id": 2}',
        '[{"id": 1}, {"id": 2},',
        '[{"id": 1}, {"text": "a]',
        '{"id": 1}',
        '{"nested": {"a": "x"}, "id": 2}\n',
        '[{"id": "one"}]',
        '[{"id": 1}] [{"id": 2}]',
        '[{"id": 1}, 7, {"id": 2}]',
        '[[{"id": 1}]]',
        '[{"id": 1}]]',
        'nothing',
    ],
)
def test_what_is_no_array_of_documents_is_an_error(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="no JSON array|MALFORMED|Malformed"):
        read_json_array(spark, str(tmp_path), SCHEMA).collect()


@pytest.mark.parametrize("text", ['[{"id": 1}, {"id": 2', '[{"id": 1}, {"text": "a]', '{"id": 1}', '[{"id": 1}]]', '[{"id": 1}, 7, {"id": 2}]', "nothing"])
def test_a_compressed_file_that_is_no_array_is_an_error(spark, tmp_path, text):
    (tmp_path / "a.json.gz").write_bytes(gzip.compress(text.encode()))
    with pytest.raises(Exception, match="no JSON array|MALFORMED|Malformed"):
        read_json_array(spark, str(tmp_path), SCHEMA).collect()


def test_compressed_arrays_of_any_text(spark, tmp_path):
    rng = random.Random(5)
    for name, indent in (("a", None), ("b", 2), ("c", None)):
        some = [document(rng, i, size=rng.choice([4, 3000])) for i in range(0 if name == "c" else 60)]
        (tmp_path / f"{name}.json.gz").write_bytes(gzip.compress(json.dumps(some, indent=indent, ensure_ascii=False).encode()))
    (tmp_path / "none.json.gz").write_bytes(gzip.compress(b""))
    assert len(rows(whole(spark, str(tmp_path)))) == 120
    assert rows(read_json_array(spark, str(tmp_path), SCHEMA)) == rows(whole(spark, str(tmp_path)))


@pytest.mark.parametrize("text", ["[]", " [ ]\n", "", "\n"])
def test_nothing_in_it(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    assert read_json_array(spark, str(tmp_path), SCHEMA).collect() == []


def test_written_arrays_come_back(spark, tmp_path):
    rng = random.Random(9)
    text = json.dumps([document(rng, i) for i in range(300)])
    (tmp_path / "a.json").write_text(text)
    documents = whole(spark, str(tmp_path / "a.json"))
    path = str(tmp_path / "out")
    write_json_arrays(documents, path, array_bytes=3000)
    files = sorted((tmp_path / "out").glob("part=*/part-*"))
    assert len(files) > 5 and all(isinstance(json.loads(f.read_text()), list) for f in files)
    assert rows(read_json_array(spark, f"{path}/*", SCHEMA)) == rows(documents)
    write_json_arrays(documents.limit(0), path)
    assert read_json_array(spark, f"{path}/*", SCHEMA).collect() == []


def shuffled(plan):
    """Bytes that the exchanges of an executed plan have taken."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return shuffled(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return shuffled(plan.plan())
    children = plan.children()
    own = plan.metrics().apply("dataSize").value() if plan.nodeName() == "Exchange" else 0
    return own + sum(shuffled(children.apply(i)) for i in range(children.size()))


def text_scans(plan):
    """The text scans of a plan."""
    if plan.nodeName().startswith("Scan text"):
        return [plan]
    children = plan.children()
    return [scan for i in range(children.size()) for scan in text_scans(children.apply(i))]


def test_only_one_scan_opens_compressed_arrays(spark, tmp_path):
    documents = spark.range(0, 2000, 1, 3).selectExpr("id", "repeat('x', 60) AS text")
    write_json_arrays(documents, f"{tmp_path}/out", array_bytes=40_000, compression="gzip")
    array = read_json_array(spark, f"{tmp_path}/out/*", SCHEMA)
    assert len(array.collect()) == 2000
    scans = text_scans(array._jdf.queryExecution().sparkPlan())
    assert sum(scan.execute().getNumPartitions() > 0 for scan in scans) == 1


def test_compressed_files_are_written_at_the_fast_level(spark, tmp_path):
    documents = spark.range(0, 3000, 1, 1).selectExpr("id", "sha2(string(id), 256) AS text")
    size = lambda name: sum(f.stat().st_size for f in (tmp_path / name).rglob("part-*.gz"))
    documents.selectExpr("to_json(struct(*))").write.option("compression", "gzip").text(f"{tmp_path}/default")
    write_json_arrays(documents, f"{tmp_path}/arrays", compression="gzip")
    write_ndjson(documents, f"{tmp_path}/lines", compression="gzip")
    assert size("arrays") > 1.01 * size("default") and size("lines") > 1.01 * size("default")


@pytest.mark.parametrize("block", [10**8, 40_000])
def test_documents_are_cut_where_they_stand(spark, tmp_path, conf, block):
    """Only what lies across the edges of blocks is shuffled, and nothing of a file that is one block."""
    file = tmp_path / "a.json"
    file.write_text(json.dumps([{"id": i, "text": f"{i} " * 40} for i in range(4000)]))
    conf(spark__sql__files__maxPartitionBytes=str(block), spark__sql__files__openCostInBytes="0")
    documents = read_json_array(spark, str(file), SCHEMA)
    assert len(documents.collect()) == 4000
    assert shuffled(documents._jdf.queryExecution().executedPlan()) < file.stat().st_size / 10


def test_writing_makes_the_documents_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    documents = spark.range(0, 3000, 1, 4).mapInArrow(count, "id bigint")
    write_json_arrays(documents, str(tmp_path / "out"), array_bytes=2000)
    assert made.value == 3000
    assert read_json_array(spark, f"{tmp_path}/out/*", SCHEMA).selectExpr("sum(id)", "count(*)").first() == (4498500, 3000)


def test_compressed_arrays_beside_cut_ones(spark, tmp_path, conf):
    rng = random.Random(11)
    (tmp_path / "a.json").write_text(json.dumps([document(rng, i) for i in range(200)]))
    documents = whole(spark, str(tmp_path / "a.json"))
    for name, compression in (("plain", "none"), ("packed", "gzip")):
        write_json_arrays(documents, f"{tmp_path}/out/{name}", array_bytes=9000, compression=compression)
    write_json_arrays(documents.limit(0), f"{tmp_path}/out/none", compression="gzip")
    conf(spark__sql__files__maxPartitionBytes="1500", spark__sql__files__openCostInBytes="0")
    assert rows(read_json_array(spark, f"{tmp_path}/out/*/*", SCHEMA)) == rows(documents.union(documents))
