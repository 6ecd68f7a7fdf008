"""Reading stored entity tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_entity(
    table: DataFrame, where: str | None = None, limit: int | None = None, order_by: str = "id"
) -> DataFrame:
    """All columns of a table, with an optional free-form predicate and row limit.

    The predicate reaches the Parquet scan; a limit follows the key, so it is repeatable.
    """
    rows = table.filter(F.expr(where)) if where else table
    return rows.orderBy(order_by).limit(limit) if limit is not None else rows


def lookup_record(table: DataFrame, record_id: int) -> DataFrame:
    return table.filter(F.col("id") == record_id)


def browse_entity(table: DataFrame, limit: int) -> DataFrame:
    return table.orderBy(F.desc("id")).limit(limit)


def search(table: DataFrame, term: str, columns: list[str], limit: int) -> DataFrame:
    """Case-insensitive substring search over several columns, newest ids first."""
    pattern = f"%{term}%"
    hit = F.lit(False)
    for name in columns:
        hit = hit | F.coalesce(F.col(name).ilike(pattern), F.lit(False))
    return browse_entity(table.filter(hit), limit)


def search_contacts(contacts: DataFrame, term: str, limit: int = 100) -> DataFrame:
    return search(contacts, term, ["given_name", "family_name", "email"], limit)


def search_companies(companies: DataFrame, term: str, limit: int = 100) -> DataFrame:
    return search(companies, term, ["name"], limit)


def read_jdbc(
    spark: SparkSession, url: str, table: str, *, key: str, lower: int, upper: int, partitions: int,
    **options: str,
) -> DataFrame:
    """A relational table read in parallel by ranges of its key."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=lower, upperBound=upper, numPartitions=partitions,
        properties=options,
    )
