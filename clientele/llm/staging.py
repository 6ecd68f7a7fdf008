"""Helpers shared by operators that work in several steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.session import work_dir


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage."""
    folder, schema = work_dir(df.sparkSession, label), df.schema
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(schema).parquet(folder)


def salted_join(many: DataFrame, few: DataFrame, on: str, by: str, how: str = "inner", salts: int = 8) -> DataFrame:
    """``many`` joined with ``few`` on a key that many rows of ``many`` may share.

    ``few`` has one row per key. The rows of a key are dealt to ``salts`` tasks by a hash of ``by``.
    """
    left = many.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    right = few.withColumn("_salt", F.explode(F.array(*[F.lit(k) for k in range(salts)])))
    return left.join(right, [on, "_salt"], how).drop("_salt")
