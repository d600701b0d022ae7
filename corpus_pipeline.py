"""A corpus through the stages of the training-data pipeline, each on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.minhash import minhash_components
from tallyline.llm.packing import default_tokenizer, pack_documents
from tallyline.llm.secrets import mask_secrets, scan_secrets
from tallyline.llm.suffixes import remove_repeats
from tallyline.llm.toxicity import fit_toxicity, score_toxicity
from tallyline.session import remove_work, rests_on, stored, work_folders


def _own(docs: DataFrame, text: Column | str = "text", n_chars: Column | None = None) -> list[Column]:
    """The columns of ``docs`` out of ``row`` (all but the text) and a text."""
    found = {"text": F.col(text) if isinstance(text, str) else text}
    if n_chars is not None:
        found["n_chars"] = n_chars
    return [(found[c] if c in found else F.col("row")[c]).alias(c) for c in docs.columns]


_tables: list[str] = []


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that removes the tables of the one before: its result has been written when the next one begins.

    Where ``docs`` still rests on one of them, as when stages are put together unwritten, all are kept.
    """

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not rests_on(docs, _tables):
            remove_work(spark, _tables)
            _tables.clear()
        before = set(work_folders())
        out = work(spark, docs, sf_dir)
        _tables.extend(f for f in work_folders() if f not in before)
        return out

    return run_stage


@_stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that are predicted to be toxic."""
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs, model).where("predicted = 0").select(*_own(docs))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents with the least ``doc_id`` of each near-duplicate component."""
    gone = minhash_components(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


#: Bytes of a repeated string that the stage cuts: less than nearly all passages of over 50 words have.
REPEATED = 224


@_stage
def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated strings of ``REPEATED`` bytes out of the texts; a text that was nothing else becomes empty.

    Where a cut leaves a part of a character, that part goes too (and with it any U+FFFD of that
    text). ``n_chars`` follows the text.
    """
    rows = docs.select("doc_id", "text", F.struct(*(c for c in docs.columns if c != "text")).alias("row"))
    kept = F.col("kept").cast("string")
    rest = F.when(F.is_valid_utf8(kept), kept).otherwise(F.replace(F.make_valid_utf8(kept), F.lit("\ufffd"), F.lit("")))
    cut = remove_repeats(rows, REPEATED).select("row", F.when(F.col("kept").isNull(), F.col("text")).otherwise(rest).alias("text"))
    return cut.select(*_own(docs, n_chars=F.coalesce(F.length("text").cast("long"), F.col("row.n_chars"))))


@_stage
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask the secrets in the texts; no document goes. ``n_chars`` follows the text."""
    masked = mask_secrets(docs, scan_secrets(docs))
    n_chars = F.coalesce(F.length("text").cast("long"), F.col("n_chars"))
    return masked.withColumn("n_chars", n_chars).select(docs.columns)


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into sequences of at most 2048 tokens."""
    return pack_documents(docs, *default_tokenizer())


STAGES = [
    ("toxicity", toxicity),
    ("minhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeats),
    ("secret_scan", secrets),
    ("best_fit_packing", packing),
]

#: The stages cannot be said in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all ``documents``; every stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
