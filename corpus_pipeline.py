"""A training-data pipeline over ``documents``: each stage works on all that the one before kept.

Stages that filter return the columns of ``documents``; so does the mix, in which a
document stands as often as its rate says. The last stage returns the tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewright.llm import bpe, mixing, near_dedup, quality, queries, toxicity
from zonewright.session import materialize

#: SQL can express neither the lexicon's learning nor compression, sampling and merges.
ORACLE_SQL = None

#: Share of two documents' shingles, in percent, from which one is a near copy of the other.
NEAR_PERCENT = 80

#: Column with the number of a row while its near copies are looked for.
ROW = "__row"


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score as toxic; null, empty and repeated texts are judged row by row, an empty table stays one."""
    scored = toxicity.score_rows(docs, queries.toxic_lexicon(spark, sf_dir))
    return scored.where(F.col("score") < toxicity.THRESHOLD).select("record.*")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the plain counts, the compression bands or the share of symbols reject.

    Null, empty and blank texts go, repeated rows are judged alike, an empty table stays one.
    """
    return quality.judge_rows(docs).where("kept").select("record.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the smallest id, of these the one with the smallest text.

    Texts are grouped, not ids: texts of one id that aren't near copies all stay. Rows without an id come after those
    with one. Texts without a word are nobody's copies and stay. Rows that are equal in id and text go by their other columns.
    """
    # what is added stands beside the record, so it clashes with no column
    record = F.struct("text", *(c for c in docs.columns if c != "text")).alias("record")
    rows = materialize(docs.select(F.monotonically_increasing_id().alias(ROW), record), "rows")
    placed = near_dedup.groups(rows.select(ROW, "record.text"), ROW, percent=NEAR_PERCENT).select(ROW, "component_id")
    nodes = materialize(rows.select(ROW, "record.doc_id").join(placed, ROW), "nodes")
    first = nodes.groupBy("component_id").agg(F.min("doc_id").alias("least"))
    # without an id in the whole component, least is null
    candidates = nodes.join(first, "component_id").where(F.col("doc_id").eqNullSafe(F.col("least"))).select(ROW, "component_id")
    kept = rows.join(candidates, ROW).groupBy("component_id").agg(F.min("record").alias("record"))
    return kept.select("record.*").select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix of languages asks for.

    Null and empty texts count no tokens and are rated by the prior; rows with one id have the same rounding; an empty table stays one.
    """
    mixed = mixing.mix(docs, queries.labelled_languages(spark, sf_dir), queries.LANGUAGE_WEIGHTS, docs.columns, seed=queries.MIX_SEED)
    copies = mixed.where("copies > 0").select("record", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    return copies.select("record.*")


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they decode to its text; null and empty texts have none, repeated rows stay."""
    return bpe.round_trip(docs, queries.BYTE_BPE, ["doc_id", "lang", "source"])


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality_rules", quality_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("bpe", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each but the last stored for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
