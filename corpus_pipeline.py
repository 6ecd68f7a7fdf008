"""A training corpus from ``documents``: quality, near duplicates, test items, personal data, mix.

Every stage reads what the one before it wrote and returns the columns of ``documents``; the last
one returns the mix, in which a document stands as often as its source's rate says. Texts go to Python
workers in batches of ``BATCH_BYTES``, so that a stage's memory does not depend on their lengths.

Defined results: nulls, empty texts, ties and repeated rows are treated as each stage's operator says
(a document without words passes the quality stage; equal rows leave one); an empty table gives no rows;
further columns of ``documents``, whatever their names, pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm import decontaminate, mixing, near_dups, ngram_quality, pii
from clientele.session import work_dir

#: SQL has no Kneser-Ney model, Poisson signatures or boosted trees.
ORACLE_SQL = None


BATCH_BYTES, GROUP_BYTES = 8 << 20, 16 << 20


def bounded(spark: SparkSession) -> None:
    """Set for the session, as a stage's result is computed after its function has returned."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("parquet.block.size", str(GROUP_BYTES))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within what trusted text of their language shows."""
    bounded(spark)
    trusted = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return ngram_quality.judge_quality(docs, trusted).where("keep").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates."""
    bounded(spark)
    return near_dups.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    bounded(spark)
    leaks = decontaminate.with_leaks(docs, _table(spark, sf_dir, "benchmark"))
    return leaks.where(F.size("leaks") == 0).select("row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weight of their source says."""
    return mixing.mix(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixture", mixture),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage is written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder, schema = work_dir(spark, name), None
        out = stage(spark, docs, sf_dir)
        schema = out.schema
        out.write.parquet(folder)
        docs = spark.read.schema(schema).parquet(folder)
    return docs
