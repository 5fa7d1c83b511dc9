"""The corpus pipeline: toxicity, SimHash near-dedup, substring dedup, secrets, packing.

Every stage takes the documents that the one before it kept and returns the columns of
``documents`` (the last: packed pieces).  What a stage decides takes effect: toxic
documents go, one document of each near-duplicate group stays, word windows that recur
go (documents that lose all their words with them), and secret spans are masked.
Documents that a stage finds nothing in are passed on as they are.

Defined results: a null or empty text is not toxic, is a near-duplicate of every other
null or empty one, has nothing to strip or mask, and packs as its end id alone; very long
texts are read whole in every stage; of a group of near-duplicates the least id stays
(null last), repeated rows once; of masked spans that overlap one mark is left; empty
tables pass through as such; further columns are kept, whatever their names, up to the
packing, which returns pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm import packing, secrets, simhash, substrings, toxicity
from quillmart.llm.common import stored, table


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is such a column, after the text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, "doc_id", "text")


def strip_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(substrings.strip(docs, "doc_id", "text"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(secrets.redact(docs, "doc_id", "text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, "doc_id", "text")).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_neardup", drop_near_duplicates),
    ("substring_dedup", strip_repeats),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack),
]

#: SQL can express neither the fitted model nor the fingerprints: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
