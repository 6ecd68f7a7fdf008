"""Landed API pages: a bare JSON list of records, or an envelope object around one list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.functions.exact_json import mark_numbers, unmark_json
from clientele.plans.specs import ENVELOPE_KEYS

_ENVELOPE = ", ".join(f"`{key}` array<string>" for key in ENVELOPE_KEYS)


def read_pages(spark: SparkSession, path: str, *, one_page_per_file: bool = False) -> DataFrame:
    """Page texts with the file they came from and ``arrival``, their order.

    Files arrive by modification time and name; inside a file, blocks by offset and lines in order.

    Pages land one per line, so large files split. ``one_page_per_file`` is for pretty-printed
    pages; a page holds at most a thousand records, so such a file fits in one row.
    """
    text = spark.read.text(path, wholetext=one_page_per_file)
    arrival = F.struct(
        F.col("_metadata.file_modification_time").alias("landed"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return text.select("value", F.col("_metadata.file_path").alias("page"), arrival.alias("arrival"))


def unwrap_pages(pages: DataFrame) -> DataFrame:
    """One row per record: the page's other columns, ``pos`` inside the page, and ``raw`` text.

    The first envelope key that holds a list wins; a page of unknown shape gives no rows. Numbers
    keep all their digits, as they stand in the page.
    """
    is_list = F.col("value").rlike(r"^\s*\[")
    # Parsed in a projection of their own, so that a page is parsed once and not once per key.
    parsed = pages.withColumn("value", mark_numbers(F.col("value"))).withColumns(
        {
            "_list": F.when(is_list, F.from_json("value", "array<string>")),
            "_envelope": F.when(~is_list, F.from_json("value", _ENVELOPE)),
        }
    )
    lists = [F.col("_envelope").getField(key) for key in ENVELOPE_KEYS]
    others = [c for c in pages.columns if c != "value"]
    records = parsed.select(*others, F.posexplode(F.coalesce("_list", *lists)).alias("pos", "raw"))
    return records.filter(F.col("raw").isNotNull()).withColumn("raw", unmark_json(F.col("raw")))


def ingest_pages(spark: SparkSession, path: str, **options) -> DataFrame:
    """Records with ``page``, ``pos``, ``raw`` and ``seq``, the order in which they arrived."""
    rows = unwrap_pages(read_pages(spark, path, **options))
    return rows.withColumn("seq", F.struct("arrival.*", "pos")).drop("arrival")


def to_pages(records: DataFrame, envelope: str | None, page_size: int = 1000) -> DataFrame:
    """Wrap records (``id``, ``raw``) the way the API lands them: pages of consecutive ids.

    A page is bounded by ``page_size`` ids, so the list it collects is too.
    """
    pages = records.groupBy(F.floor(F.col("id") / page_size).alias("page_no")).agg(
        F.array_sort(F.collect_list(F.struct("id", "raw"))).alias("items")
    )
    body = F.concat(F.lit("["), F.array_join(F.col("items.raw"), ","), F.lit("]"))
    if envelope:
        body = F.concat(F.lit(f'{{"{envelope}":'), body, F.lit("}"))
    return pages.select(body.alias("value"))
