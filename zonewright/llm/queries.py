"""One query per operator, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewright.llm import (
    bpe,
    exact_topk,
    fill_in_middle,
    license_scan,
    mixing,
    near_dedup,
    quality,
    sharding,
    token_counts,
    token_files,
    toxicity,
    url_filter,
    vector_codes,
)
from zonewright.session import materialize, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

#: Id after each document in files of token ids.
END_ID = 1

#: Tokens beyond which a text counts as over the limit.
TOKEN_LIMIT = 4096


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")

#: Shards, and the seed of their order.
N_SHARDS, SHARD_SEED = 8, 20

#: Results of a search.
TOP_K = 10

#: Shares of tokens that the mix is to have, and the seed of its rounding.
LANGUAGE_WEIGHTS, MIX_SEED = {"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2}, 6

# The rules for URLs.
URL_RULES = (
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
)


@query
def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents in a random order, dealt to shards whose counts differ by one at most."""
    shuffled = sharding.shuffle(table(spark, folder, "documents"), N_SHARDS, SHARD_SEED)
    text = F.coalesce(F.col("record.text"), F.lit(""))
    return shuffled.select(
        "record.doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Encode every whole text, decode the ids, and give a digest of both."""
    encoded = bpe.encode(table(spark, folder, "documents"), BYTE_BPE, ["doc_id"])
    encoded = encoded.withColumn("ids_sha256", F.sha2("ids", 256))
    decoded = bpe.decode(encoded, BYTE_BPE, ["doc_id", "n_tokens", "ids_sha256"])
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every whole text, and whether they are over the limit."""
    counts = token_counts.count_tokens(table(spark, folder, "documents"), PIECE_BPE, ["doc_id"])
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def held_out() -> Column:
    """The part of the rows that no label is learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def toxic_lexicon(spark: SparkSession, folder: str) -> toxicity.Lexicon:
    labels = table(spark, folder, "labels").where(~held_out())
    return toxicity.learn(table(spark, folder, "documents"), labels)


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every whole text, by a lexicon learned from the rows that aren't held out."""
    lexicon = toxic_lexicon(spark, folder)
    scores = toxicity.score_texts(table(spark, folder, "documents"), lexicon, ["doc_id"])
    return scores.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


@query
def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and notices in every whole text."""
    return license_scan.scan_texts(table(spark, folder, "documents"), ["doc_id"])


@query
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Plain counts and compression bands of every whole text."""
    return quality.judge_texts(table(spark, folder, "documents"), ["doc_id"], symbol_percent=None)


@query
def op8_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The ten rows with the highest scores for every hundredth vector."""
    vectors = table(spark, folder, "embeddings")
    return exact_topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), TOP_K)


ORACLE["op8_exact_topk"] = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
    FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.ints::DOUBLE[], c.ints::DOUBLE[]) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored
)
SELECT * FROM ranked WHERE rank <= 10
"""


def labelled_languages(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that the table of labels holds, with their language as the domain."""
    documents = table(spark, folder, "documents").select("doc_id", F.col("lang").alias("domain"))
    return documents.join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi")


@query
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Rate and copies of every document for target shares of four languages, which the text alone tells."""
    documents = table(spark, folder, "documents")
    mixed = mixing.mix(documents, labelled_languages(spark, folder), LANGUAGE_WEIGHTS, ["doc_id"], seed=MIX_SEED)
    return mixed.select("record.doc_id", "domain", "n_tokens", "posterior", "rate", "copies")


@query
def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Rule and verdict of every page's URL."""
    model = url_filter.train(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, folder, "pages"), model, URL_RULES, "page_id")


@query
def op5_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents that share 85 percent of their shingles, directly or through others."""
    return near_dedup.groups(table(spark, folder, "documents"), percent=85)


@query
def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Write the ids of all documents to files and read them back."""
    written = scratch_path(spark, "token_files")
    token_files.write(table(spark, folder, "documents"), WORD_BPE, written, END_ID)
    return token_files.read(spark, written).select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Code and error of every vector, the error of its label, and a digest of the codebooks."""
    vectors = table(spark, folder, "embeddings")
    books = vector_codes.fit(vectors)
    encoded = materialize(vector_codes.encode(vectors, books, ["vec_id", "label"]), "codes")  # read twice
    coded = vector_codes.group_errors(encoded, "label", total="label_error")
    code = F.lower(F.hex("code")).alias("code")
    return coded.select("vec_id", code, "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


@query
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Cut every whole text at two drawn tokens, move its middle to the end, and put it together again."""
    moved = fill_in_middle.rearrange(fill_in_middle.with_index(table(spark, folder, "documents")))
    sha256 = lambda c: F.sha2(c.cast("binary"), 256)
    return moved.select(
        "record.doc_id",
        "index.n",
        "form",
        F.col("cuts.start").alias("prefix_chars"),
        (F.col("cuts.end") - F.col("cuts.start")).alias("middle_chars"),
        sha256(F.col("output")).alias("output_sha256"),
        sha256(fill_in_middle.restored("output", "form")).alias("restored_sha256"),
    )


def _vector_code_sql() -> str:
    """Two rounds of assignment and means, then the last assignment, one common table after the other."""
    distances = """
        SELECT p.vec_id, p.part, b.entry, list_sum(list_transform(list_zip(p.ints, b.ints), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
        FROM parts p JOIN {books} b ON b.part = p.part
    """
    assigned = f"""
        SELECT vec_id, part, min_by(entry, (distance, entry)) AS entry, min(distance)::BIGINT AS distance FROM ({distances}) GROUP BY vec_id, part
    """
    moved = """
        SELECT b.part, b.entry, coalesce(list(n.component ORDER BY n.place) FILTER (n.place IS NOT NULL), any_value(b.ints)) AS ints
        FROM {books} b LEFT JOIN (
            SELECT part, entry, place, floor(sum(component)::DOUBLE / count(*))::BIGINT AS component
            FROM (
                SELECT a.part, a.entry, generate_subscripts(p.ints, 1) AS place, unnest(p.ints) AS component
                FROM {assigned} a JOIN parts p ON p.vec_id = a.vec_id AND p.part = a.part
            )
            GROUP BY part, entry, place
        ) n ON n.part = b.part AND n.entry = b.entry
        GROUP BY b.part, b.entry
    """
    return f"""
WITH vectors AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
    FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT vec_id, part, list_slice(ints, part * (len(ints) // 16) + 1, (part + 1) * (len(ints) // 16)) AS ints
    FROM vectors, range(16) t(part)
), books0 AS MATERIALIZED (
    SELECT part, rank - 1 AS entry, ints
    FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id) AS rank FROM parts) WHERE rank <= 64
), assigned0 AS MATERIALIZED ({assigned.format(books="books0")}
), books1 AS MATERIALIZED ({moved.format(books="books0", assigned="assigned0")}
), assigned1 AS MATERIALIZED ({assigned.format(books="books1")}
), books2 AS MATERIALIZED ({moved.format(books="books1", assigned="assigned1")}
), assigned2 AS MATERIALIZED ({assigned.format(books="books2")}
), digest AS (
    SELECT sha256(string_agg(array_to_string(ints, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books2
), coded AS (
    SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(distance)::BIGINT AS error
    FROM assigned2 GROUP BY vec_id
)
SELECT c.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY v.label))::BIGINT AS label_error, d.codebooks_sha256
FROM coded c JOIN vectors v ON v.vec_id = c.vec_id, digest d
"""


ORACLE["op12_vector_codes"] = _vector_code_sql()

ORACLE["op13_fill_in_middle"] = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
    FROM documents
), numbers AS (
    SELECT *, CAST(len(tokens) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
        CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
    FROM cut
), drawn AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
             WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers
), parted AS (
    SELECT *, array_to_string(tokens[1:low], '') AS prefix, array_to_string(tokens[low + 1:high], '') AS middle,
        array_to_string(tokens[high + 1:], '') AS suffix
    FROM drawn
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text
        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parted
"""
