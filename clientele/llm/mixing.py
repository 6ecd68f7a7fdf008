"""Mixing sources to target weights: tokens per source, repetition rates, seeded copies.

Sources are taken in code point order, a null source last, and weigh ``weights`` in turn. They
share ``share`` times all tokens; a source's target stops at ``most`` times its own tokens and the
excess goes to the others by weight until none is above. A document is emitted floor(rate) times
plus one copy with probability equal to the fraction, where rate = target / tokens of the source.
The copy is drawn from a hash of the seed, ``doc_id`` and text, so reruns and retried tasks agree.

Defined results: a null text or one of white space has size 0 and is taken at its source's rate
like any other (0 tokens); a source without tokens has target 0 and rate 0; repeated rows are drawn
alike; an empty table gives an empty result; other columns, whatever their names, pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE, MOST, SEED = 1.5, 2, "mix-1"


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_rates(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """(source, source_size, target, rate), one row per source.

    The water level is found without iterating: sources are ordered by the level at which they
    reach their cap, and sums over that order give the level each would leave to the rest. The
    windows see one row per source, never rows of documents.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1)).withColumn(
        "cap", F.col("source_size") * most
    )
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    rest = filled.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = left / F.sum("weight").over(rest)
    capped = weighed.withColumn("level", level).withColumn(
        # the first source that the level does not fill, and all after it, get level times weight
        "open", F.max((F.col("cap") > F.col("level") * F.col("weight")).cast("int")).over(
            filled.rowsBetween(Window.unboundedPreceding, 0))
    )
    final = F.min(F.when(F.col("open") == 1, F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)
    target = F.when(F.col("open") == 1, final["level"] * F.col("weight")).otherwise(F.col("cap").cast("double"))
    return (
        capped.withColumn("target", F.least(target, F.col("cap").cast("double")))
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .select("source", "source_size", "target", "rate")
    )


def drawn(seed: str, doc_id: Column, text: Column) -> Column:
    """A number in [0, 1) from 48 bits of an md5."""
    key = F.concat_ws("\x1f", F.lit(seed), doc_id.cast("string"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def mixing_plan(docs: DataFrame, seed: str = SEED, **options) -> DataFrame:
    """``docs`` packed as ``row`` with size, source_size, target, rate and copies."""
    rows = docs.select(
        F.struct("*").alias("row"),
        tokens(F.col("text")).alias("size"),
        F.col("source").alias("source"),
        drawn(seed, F.col("doc_id"), F.col("text")).alias("draw"),
    )
    # Only (source, size) is aggregated; partial sums leave one row per source and task.
    rates = source_rates(docs.select("source", tokens(F.col("text")).alias("size")), **options)
    rates = rates.withColumnRenamed("source", "rate_source")
    whole = F.floor("rate")
    return (
        rows.join(rates, F.col("source").eqNullSafe(F.col("rate_source")))
        .withColumn("copies", (whole + (F.col("draw") < F.col("rate") - whole).cast("int")).cast("int"))
        .drop("rate_source", "draw")
    )


def mix(docs: DataFrame, seed: str = SEED, **options) -> DataFrame:
    """The mix itself: every document as many times as the plan says."""
    planned = mixing_plan(docs, seed, **options).where("copies > 0")
    return planned.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
