"""The validation pack: every check with its severity, and a summary over all of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.operators import checks
from clientele.plans.specs import ENTITIES

Tables = Mapping[str, DataFrame]


def _count(find: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    return lambda t: find(t).agg(F.count("*").alias("issue_count"))


def _orphans(name: str, *columns: str) -> checks.OrphanCheck:
    return checks.OrphanCheck(ENTITIES[name], columns)


# A reference check, or a function that gives one row with ``issue_count``.
Check = checks.OrphanCheck | Callable[[Tables], DataFrame]
CHECKS: dict[str, Check] = {
    "contact_tags_missing_contact_or_tag": _orphans("contact_tags"),
    "opps_missing_stage": _orphans("opportunities", "stage_id"),
    "opps_missing_pipeline": _orphans("opportunities", "pipeline_id"),
    "tasks_missing_parents": _orphans("tasks", "contact_id", "opportunity_id"),
    "notes_missing_parents": _orphans("notes", "contact_id", "opportunity_id"),
    "stage_pipeline_mismatch": _count(
        lambda t: checks.stage_pipeline_mismatch(t["opportunities"], t["stages"])
    ),
    "order_reconciliation": _count(
        lambda t: checks.order_reconciliation(t["orders"], t["order_items"])
    ),
    "overpaid_orders": _count(lambda t: checks.overpaid_orders(t["orders"], t["payments"])),
    "duplicate_emails": _count(lambda t: checks.duplicate_email_groups(t["contacts"])),
    "missing_company_name": _count(lambda t: checks.missing_company_name(t["companies"])),
    "missing_contact_names": _count(lambda t: checks.missing_contact_names(t["contacts"])),
    "json_shape_check": _count(lambda t: checks.json_shape_check(t["contacts"])),
}


def issue_counts(tables: Tables, pack: Mapping[str, Check] = CHECKS) -> DataFrame:
    """(check_name, issue_count, failed) per check.

    The reference checks of a table share one look at its foreign keys. Nothing runs while the plan is
    built. A check that cannot be
    built, because a table or column is missing, counts as one issue with ``failed`` set; the
    others still run.
    """
    spark = SparkSession.active()
    references: dict[str, checks.OrphanCheck] = {}
    parts, broken = [], []
    for name, check in pack.items():
        try:
            if isinstance(check, checks.OrphanCheck):
                checks.orphan_counts(tables, {name: check}, "check_name", "issue_count")
                references[name] = check
            else:
                found = check(tables).select(F.col("issue_count").cast("bigint").alias("issue_count"))
                parts.append(checks.labelled(found, name, "check_name"))
        except (PySparkException, KeyError):
            broken.append((name, 1, True))
    if references:
        parts.append(checks.orphan_counts(tables, references, "check_name", "issue_count"))
    parts = [p.withColumn("failed", F.lit(False)) for p in parts]
    if broken:
        shape = "check_name string, issue_count bigint, failed boolean"
        parts.append(spark.createDataFrame(broken, shape))
    return checks.union_all(parts)


def validation_summary(tables: Tables, pack: Mapping[str, Check] = CHECKS) -> DataFrame:
    """(check_name, issue_count, outcome) per check, and a ``TOTAL`` row with the verdict."""
    # ROLLUP adds the total over all checks in the same aggregate.
    rolled = issue_counts(tables, pack).rollup("check_name").agg(
        F.sum("issue_count").alias("issue_count"), F.max("failed").alias("failed")
    )
    is_total = F.col("check_name").isNull()
    clean = F.col("issue_count") == 0
    outcome = (
        F.when(is_total, F.when(clean, "passed").otherwise("failed"))
        .when(F.col("failed"), "error")
        .when(clean, "clean")
        .otherwise(F.concat(F.col("issue_count").cast("string"), F.lit(" issues")))
    )
    return rolled.select(
        F.coalesce("check_name", F.lit("TOTAL")).alias("check_name"), "issue_count",
        outcome.alias("outcome"),
    )

