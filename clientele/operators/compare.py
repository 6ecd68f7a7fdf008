"""Field-by-field comparison of two versions of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.plans.specs import Entity


def table_diff(left: DataFrame, right: DataFrame, entity: Entity, *, matches: bool = False) -> DataFrame:
    """(key, field, left_value, right_value, status) for each compared field of each key.

    ``mismatch``: both values are set and differ; ``missing``: one of them is not set;
    ``match``: they are equal, listed only on request.
    """
    fields = [c for c in entity.compare if c in left.columns and c in right.columns]
    keys = list(entity.key)
    a = left.select(*keys, F.struct(*[F.col(c).cast("string").alias(c) for c in fields]).alias("_a"))
    b = right.select(*keys, F.struct(*[F.col(c).cast("string").alias(c) for c in fields]).alias("_b"))
    both = a.join(b, keys, "full_outer")
    triples = ", ".join(f"'{c}', _a.`{c}`, _b.`{c}`" for c in fields)
    long = both.select(
        *keys, F.expr(f"stack({len(fields)}, {triples}) AS (field, left_value, right_value)")
    )
    status = (
        F.when(F.col("left_value").eqNullSafe(F.col("right_value")), "match")
        .when(F.col("left_value").isNull() | F.col("right_value").isNull(), "missing")
        .otherwise("mismatch")
    )
    marked = long.withColumn("status", status)
    return marked if matches else marked.filter("status != 'match'")
