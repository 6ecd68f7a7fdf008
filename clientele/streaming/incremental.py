"""Incremental ingest of landed pages with Structured Streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.operators.flatten import good_rows, rejected_rows, with_reason
from clientele.operators.merge import latest_per_key
from clientele.plans.specs import Entity
from clientele.session import session_settings
from clientele.sources.pages import unwrap_pages
from clientele.sources.versions import VersionedTable, path_exists

# The repeats to remember outgrow memory; RocksDB keeps them on the executors' disks.
STATE_STORE: dict[str, str] = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
ARRIVAL = ("written_at", "page", "line", "pos")


def version_column(entity: Entity) -> str:
    return "updated_at" if "updated_at" in entity.columns else "created_at"


def page_stream(spark: SparkSession, landing: str, files_per_batch: int = 1000) -> DataFrame:
    """New page files as they land, one page per line, with the number of the line.

    A stream has no row numbers, so a file is read whole and split into its lines: a landed file is
    one poll's pages, some MB. A file of 2 GB or more fails and is not read in part.
    """
    text = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch)
    return text.option("wholetext", True).load(landing).select(
        F.posexplode(F.split("value", r"\r\n|\n|\r")).alias("line", "value"),
        F.col("_metadata.file_path").alias("page"),
        F.col("_metadata.file_modification_time").alias("written_at"),
        F.current_timestamp().alias("landed_at"),
    )


def typed_stream(pages: DataFrame, entity: Entity, repeat_window: str) -> DataFrame:
    """Typed rows without the exact repeats seen inside ``repeat_window``; see ``with_reason``.

    A repeat has the same key, the same ``updated_at`` and the same payload; the key alone
    would lose updates. The watermark runs on the time of arrival, so no record is ever late.
    """
    records = unwrap_pages(pages)
    rows = with_reason(records, entity, keep=(*ARRIVAL, "landed_at"))
    hashed = rows.withColumn("_payload", F.xxhash64("raw"))
    return (
        hashed.withWatermark("landed_at", repeat_window)
        .dropDuplicatesWithinWatermark([*entity.key, version_column(entity), "_payload"])
        .drop("_payload")
    )


class IncrementalLoad:
    """Keeps one entity's table up to date with the pages in a landing folder.

    Each micro-batch writes its rows to its own folder, replacing what an earlier attempt of
    the same batch left there. ``merge`` then folds the new batches into the table, once per
    drain and not once per batch, so the work of a batch does not grow with the table.
    """

    def __init__(self, spark: SparkSession, landing: str, store: str, entity: Entity):
        self.spark = spark
        self.landing = landing
        self.entity = entity
        self.changes = f"{store}/changes/{entity.name}"
        self.checkpoint = f"{store}/progress/{entity.name}"
        self.table = VersionedTable(spark, f"{store}/{entity.name}", entity.key)
        self.version_column = version_column(entity)

    def _write_batch(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.changes}/batch={batch_id}")

    def drain(self, repeat_window: str = "7 days", files_per_batch: int = 1000) -> None:
        """Process all pages that have landed since the last call, then stop."""
        pages = page_stream(self.spark, self.landing, files_per_batch)
        writer = (
            typed_stream(pages, self.entity, repeat_window)
            .writeStream.foreachBatch(self._write_batch)
            .option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
        )
        with session_settings(self.spark, STATE_STORE):
            query = writer.start()
        query.awaitTermination()

    def merge(self) -> DataFrame | None:
        """Fold the batches not merged yet into the table and return it.

        The newest ``updated_at`` of a key wins, then the latest arrival, so a page that is
        replayed long after does not bring old values back. The version remembers the last
        batch it holds; a merge that died is simply done again.
        """
        table = self.table
        if not path_exists(self.spark, self.changes):
            return table.current()
        batches = self.spark.read.parquet(self.changes)
        if table.last_tag() is not None:
            batches = batches.filter(F.col("batch") > table.last_tag())
        newest_batch = batches.agg(F.max("batch")).first()[0]
        if newest_batch is None:
            return table.current()
        good = good_rows(batches.drop("landed_at"))
        order = (self.version_column, "batch", *ARRIVAL)
        changed = latest_per_key(good, self.entity.key, order).drop("batch", *ARRIVAL)
        if not table.version:
            table.replace(changed, tag=newest_batch)
            return table.current()
        # Stored, so that the merge does not repeat this work and Catalyst knows its size.
        staged = f"{self.changes}-merging/{uuid.uuid4().hex}"
        self._newer_than(changed, table.near(good)).write.parquet(staged)
        table.merge(self.spark.read.parquet(staged), tag=newest_batch)
        return table.current()

    def rejected(self) -> DataFrame:
        """Landed records that could not be loaded, with the page and the reason."""
        return rejected_rows(self.spark.read.parquet(self.changes), keep=("page", "line", "pos"))

    def _newer_than(self, changed: DataFrame, near: DataFrame) -> DataFrame:
        """Changes that are not older than the stored row of their key."""
        stored = near.select(*self.entity.key, F.col(self.version_column).alias("_stored"))
        older = F.col(self.version_column) < F.col("_stored")
        both = changed.join(stored, list(self.entity.key), "left")
        return both.filter(F.coalesce(~older, F.lit(True))).drop("_stored")
