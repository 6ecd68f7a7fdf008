"""Analysis of load runs: requests, throttling, errors, progress and drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNFINISHED: tuple[str, ...] = ("pending", "running", "failed")


def for_run(df: DataFrame, run_id: int | None, runs: DataFrame | None = None) -> DataFrame:
    """Rows of one run; with ``run_id`` left out, of the latest run in ``runs``."""
    if run_id is not None:
        return df.filter(F.col("run_id") == run_id)
    latest = runs.orderBy(F.desc("started_at"), F.desc("id")).limit(1).select("id")
    return df.filter(F.col("run_id") == latest.scalar())


def run_metrics(runs: DataFrame, requests: DataFrame) -> DataFrame:
    """Totals per run; a run without requests has zeros."""
    totals = requests.groupBy("run_id").agg(
        F.count("*").alias("total_requests"),
        F.sum("item_count").alias("total_items"),
        F.sum("duration_ms").alias("total_duration_ms"),
        F.count(F.when(F.col("error").isNotNull(), 1)).alias("error_count"),
        F.count(F.when(F.col("throttled"), 1)).alias("throttle_count"),
    )
    names = [c for c in totals.columns if c != "run_id"]
    joined = runs.select("id").join(totals, F.col("id") == F.col("run_id"), "left")
    return joined.select(F.col("id").alias("run_id"), *[F.coalesce(n, F.lit(0)).alias(n) for n in names])


def entity_performance(metrics: DataFrame) -> DataFrame:
    """Pages, items, timings, throttling and throughput per run and entity."""
    total_ms = F.col("total_duration_ms")
    per_second = F.when(total_ms > 0, F.col("total_items") * 1000.0 / total_ms).otherwise(0.0)
    return (
        metrics.groupBy("run_id", "entity")
        .agg(
            F.count("*").alias("total_pages"),
            F.sum("item_count").alias("total_items"),
            F.sum("duration_ms").alias("total_duration_ms"),
            F.avg("duration_ms").alias("avg_page_duration_ms"),
            F.min("duration_ms").alias("min_page_duration_ms"),
            F.max("duration_ms").alias("max_page_duration_ms"),
            F.count(F.when(F.col("throttle_remaining") < 100, 1)).alias("throttle_hits"),
            F.sum("retry_count").alias("retry_attempts"),
            F.count(F.when(F.col("error_message").isNotNull(), 1)).alias("error_count"),
        )
        .withColumn("throughput_items_per_second", per_second.cast("double"))
    )


def run_performance_summary(performance: DataFrame) -> DataFrame:
    return performance.select(
        "entity", "total_pages", "total_items", "total_duration_ms", "avg_page_duration_ms",
        "throttle_hits", "error_count", "throughput_items_per_second",
    ).orderBy(F.desc("total_items"), "entity")


def throttle_analysis(throttles: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return (
        throttles.groupBy(*by, "entity", "endpoint", "throttle_type")
        .agg(
            F.count("*").alias("throttle_events"),
            F.avg("throttle_remaining").alias("avg_throttle_remaining"),
            F.sum("wait_time_ms").alias("total_wait_time_ms"),
        )
        .orderBy(F.desc("throttle_events"), *by, "entity", "endpoint", "throttle_type")
    )


def error_analysis(errors: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Errors per entity and type with one message; the smallest, so that it is repeatable."""
    return (
        errors.groupBy(*by, "entity", "error_type")
        .agg(
            F.count("*").alias("error_count"),
            F.min("error_message").alias("sample_error_message"),
        )
        .orderBy(F.desc("error_count"), *by, "entity", "error_type")
    )


def source_vs_loaded(source_counts: DataFrame, loaded: DataFrame) -> DataFrame:
    """Items retrieved per run and entity beside the rows the entity's table holds now."""
    held = loaded.select("entity", F.col("row_count").alias("rows_loaded"))
    return source_counts.select("run_id", "entity", "items_retrieved").join(held, "entity", "left")


# --- snapshots -------------------------------------------------------------------------


def rank_snapshots(snapshots: DataFrame) -> DataFrame:
    """Every snapshot with its place among its table's snapshots, newest run first.

    A table has one snapshot per run, so a group is as large as the run log.
    """
    newest = Window.partitionBy("table_name").orderBy(F.desc("run_id"))
    ranked = snapshots.withColumn("rn", F.row_number().over(newest).cast("bigint"))
    return ranked.select("table_name", "row_count", "run_id", "rn")


def snapshot_delta(snapshots: DataFrame, schema: str = "crm") -> DataFrame:
    """Row counts of the latest run and the one before, per table.

    Only the two newest snapshots of a table leave each map task: Catalyst pushes the bound on
    ``row_number`` below the shuffle.
    """
    newest = Window.partitionBy("table_name").orderBy(F.desc("run_id"))
    two = (
        snapshots.filter(F.col("schema_name") == schema)
        .withColumn("rn", F.row_number().over(newest))
        .filter("rn <= 2")
    )
    counts = two.groupBy("table_name").agg(
        F.max(F.when(F.col("rn") == 1, F.col("row_count"))).alias("current_rows"),
        F.max(F.when(F.col("rn") == 2, F.col("row_count"))).alias("previous_rows"),
    )
    delta = F.col("current_rows") - F.coalesce("previous_rows", F.lit(0))
    return counts.withColumn("delta", delta).orderBy("table_name")


# --- run log ---------------------------------------------------------------------------


def recent_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    return (
        runs.select("id", "status", "started_at", "finished_at", "notes")
        .orderBy(F.desc("started_at"), F.desc("id"))
        .limit(limit)
    )


def run_durations(runs: DataFrame, limit: int = 10) -> DataFrame:
    seconds = (F.unix_micros(F.col("finished_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))) / 1e6
    return recent_runs(runs, limit).withColumn("duration_seconds", seconds)


def request_metrics_for_run(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("created_at", "id").select(
        "entity", "endpoint", "item_count", "duration_ms", "throttle_remaining"
    )


def system_health_for_run(health: DataFrame) -> DataFrame:
    return health.orderBy(F.desc("recorded_at"), "id").select(
        "metric_name", "metric_value", "metric_unit", "tags", "recorded_at"
    )


def interrupted_runs(runs: DataFrame, progress: DataFrame, current_run: int | None = None) -> DataFrame:
    """The latest run still marked running that has unfinished entities."""
    open_runs = runs.filter("status = 'running'")
    if current_run is not None:
        open_runs = open_runs.filter(F.col("id") != current_run)
    unfinished = progress.filter(F.col("status").isin(*UNFINISHED)).select("run_id")
    return (
        open_runs.join(unfinished, F.col("id") == F.col("run_id"), "left_semi")
        .select("id", "started_at")
        .orderBy(F.desc("started_at"), F.desc("id"))
        .limit(1)
    )


def entities_to_resume(progress: DataFrame) -> DataFrame:
    return (
        progress.filter(F.col("status").isin(*UNFINISHED))
        .orderBy("created_at", "entity")
        .select(F.col("entity").alias("entity_name"), "last_page_offset", "last_page_limit")
    )


def last_successful_run(runs: DataFrame, progress: DataFrame) -> DataFrame:
    """Per entity, the latest successful run that completed it; 0 where there is none."""
    good_runs = runs.filter("status = 'success'").select(F.col("id").alias("run_id"), "started_at")
    done = progress.select("entity", "run_id", "status").join(good_runs, "run_id", "left")
    counts = (F.col("status") == "completed") & F.col("started_at").isNotNull()
    order = F.when(counts, F.struct("started_at", "run_id"))
    return done.groupBy("entity").agg(
        F.coalesce(F.max(order).getField("run_id"), F.lit(0)).cast("bigint").alias("last_run_id")
    )


def latest_checkpoint(checkpoints: DataFrame) -> DataFrame:
    """The newest checkpoint of each run, entity and type."""
    return checkpoints.groupBy("run_id", "entity", "checkpoint_type").agg(
        F.max_by("checkpoint_data", F.struct("created_at", "seq")).alias("checkpoint_data")
    )


def checkpoint_of(checkpoints: DataFrame, run_id: int, entity: str, kind: str) -> DataFrame:
    """One row: that checkpoint, or ``{}`` where none was saved."""
    wanted = checkpoints.filter(
        (F.col("run_id") == run_id)
        & (F.col("entity") == entity)
        & (F.col("checkpoint_type") == kind)
    )
    newest = F.max_by("checkpoint_data", F.struct("created_at", "seq"))
    return wanted.agg(F.coalesce(newest, F.lit("{}")).alias("checkpoint_data"))
