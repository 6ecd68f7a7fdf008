"""Contact files: lookups, statistics, and what a sync finds and stores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEGABYTE = 1024 * 1024
FILE_KEY = ("contact_id", "file_hash")


def _megabytes(size: Column) -> Column:
    return F.round(size.cast("decimal(38,0)") / F.lit(MEGABYTE).cast("decimal(10,0)"), 2).cast(
        "decimal(38,2)"
    )


def files_with_contacts(files: DataFrame, contacts: DataFrame, contact_id: int | None = None) -> DataFrame:
    """Files with the contact they belong to; each row carries ``created_at`` for ordering."""
    chosen = files if contact_id is None else files.filter(F.col("contact_id") == contact_id)
    names = contacts.select(F.col("id").alias("_contact"), "given_name", "family_name", "email")
    joined = chosen.join(names, F.col("contact_id") == F.col("_contact")).drop("_contact")
    return joined.orderBy(F.desc("created_at"), F.desc("id"))


def large_files(files: DataFrame, threshold_mb: int = 10) -> DataFrame:
    return (
        files.filter(F.col("file_size") > threshold_mb * MEGABYTE)
        .orderBy(F.desc("file_size"), "id")
        .select(
            "contact_id", "file_name", F.col("file_size").alias("file_size_bytes"),
            _megabytes(F.col("file_size")).alias("file_size_mb"), "mime_type", "created_at",
        )
    )


def files_by_type(files: DataFrame, mime_type: str) -> DataFrame:
    return (
        files.filter(F.col("mime_type") == mime_type)
        .orderBy(F.desc("created_at"), F.desc("id"))
        .select(
            "contact_id", "file_name", F.col("file_size").alias("file_size_bytes"), "file_path",
            "created_at",
        )
    )


def _type_map(pairs: str) -> Column:
    """{type: count}, by type; as many entries as there are types, not files."""
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", pairs))))


def _per_type(files: DataFrame, *keys: str) -> DataFrame:
    kind = F.coalesce("mime_type", F.lit("unknown")).alias("type")
    return files.groupBy(*keys, kind).agg(
        F.count("*").alias("n"), F.sum("file_size").alias("bytes")
    )


def file_stats(files: DataFrame) -> DataFrame:
    """Totals over all files; files are first counted per type and contact."""
    per_contact = _per_type(files, "contact_id")
    types = per_contact.groupBy("type").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    contacts = per_contact.select("contact_id").distinct()
    seen = contacts.agg(F.count("contact_id").alias("contacts"))
    parts = types.unionByName(seen, allowMissingColumns=True)
    is_type = F.col("type").isNotNull()
    entries = F.array_sort(F.collect_list(F.when(is_type, F.struct("type", "n"))))
    totals = parts.agg(
        F.sum("n").alias("total_files"),
        F.sum("bytes").alias("total_size_bytes"),
        F.sum("contacts").alias("contacts_with_files"),
        F.map_from_entries(entries).alias("files_by_type"),
    )
    size, number = F.col("total_size_bytes"), F.col("total_files")
    average = F.round(size.cast("decimal(38,0)") / number.cast("decimal(19,0)"), 2)
    return totals.select(
        "total_files", "total_size_bytes", _megabytes(size).alias("total_size_mb"),
        "contacts_with_files", average.cast("decimal(38,2)").alias("avg_file_size_bytes"),
        "files_by_type",
    )


def contact_file_summary(files: DataFrame, contact_id: int | None = None) -> DataFrame:
    chosen = files if contact_id is None else files.filter(F.col("contact_id") == contact_id)
    return (
        _per_type(chosen, "contact_id")
        .groupBy("contact_id")
        .agg(
            F.sum("n").alias("total_files"),
            F.sum("bytes").alias("total_size_bytes"),
            _type_map("n").alias("file_types"),
        )
    )


# --- sync ------------------------------------------------------------------------------


def new_files_only(incoming: DataFrame, known: DataFrame) -> DataFrame:
    """Incoming files whose (contact, hash) is not stored yet."""
    return incoming.join(known.select(*FILE_KEY).distinct(), list(FILE_KEY), "left_anti")


def file_sync_totals(incoming: DataFrame, known: DataFrame) -> DataFrame:
    """Files found, stored and skipped per contact, and in total (``contact_id`` NULL).

    A file without an address, an already stored one, and each further copy inside the batch
    are skipped. Copies are counted before the join, so a file copied many times is one row.
    """
    copies = incoming.groupBy(*FILE_KEY).agg(
        F.count("*").alias("found"),
        F.count("file_path").alias("_with_path"),
    )
    stored = known.select(*FILE_KEY).distinct().withColumn("_known", F.lit(1))
    marked = copies.join(stored, list(FILE_KEY), "left").withColumn(
        "stored", F.when(F.col("_known").isNull() & (F.col("_with_path") > 0), 1).otherwise(0)
    )
    return (
        marked.rollup("contact_id")
        .agg(F.sum("found").alias("files_found"), F.sum("stored").alias("files_stored"))
        .withColumn("files_skipped", F.col("files_found") - F.col("files_stored"))
    )


def merge_files(known: DataFrame, incoming: DataFrame) -> DataFrame:
    """Upsert on (contact, hash).

    The first row of a key gives its id, creation time and remote id; the last one gives the
    rest; ``updated_at`` is set once a key has been written again. ``seq`` orders the incoming
    rows and ``at`` is their time of writing. Only aggregates are used, so a file that makes up
    a third of the batch folds into one row per map task.
    """
    kept = ["id", "remote_file_id", "created_at"]
    fresh = ["file_name", "file_path", "file_size", "mime_type"]
    old = known.select(
        *FILE_KEY, *kept, *fresh, F.lit(-1).cast("bigint").alias("seq"),
        F.lit(None).cast("timestamp_ntz").alias("at"),
    )
    new = incoming.select(*FILE_KEY, *kept, *fresh, "seq", "at")
    rows = old.unionByName(new)
    first = F.min_by(F.struct(*kept), "seq")
    last = F.max_by(F.struct(*fresh, "at"), "seq")
    merged = rows.groupBy(*FILE_KEY).agg(
        first.alias("_first"), last.alias("_last"), F.count("*").alias("_n")
    )
    return merged.select(
        "_first.id", *FILE_KEY, *[f"_last.{c}" for c in fresh], "_first.remote_file_id",
        "_first.created_at", F.when(F.col("_n") > 1, F.col("_last.at")).alias("updated_at"),
    )
