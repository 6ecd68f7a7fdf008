"""Set-based upserts: each operator gives the table after the load, as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientele.plans.specs import Entity


def latest_per_key(rows: DataFrame, key: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """The last row written for each key, as sequential upserts would leave it.

    The bound on ``row_number`` is pushed below the shuffle, so each map task sends at most one
    row per key, however often a key repeats.
    """
    last = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order])
    return rows.withColumn("_rn", F.row_number().over(last)).filter("_rn = 1").drop("_rn")


def default_order(rows: DataFrame, key: tuple[str, ...]) -> tuple[str, ...]:
    """An order for rows without arrival order: by ``updated_at`` where there is one, then by content.

    Rows that are nothing but their key are all alike.
    """
    content = [c for c, kind in rows.dtypes if c not in (*key, "updated_at") and "map<" not in kind]
    return (*[c for c in rows.columns if c == "updated_at"], *content) or key


def merge_rows(
    target: DataFrame, updates: DataFrame, key: tuple[str, ...], order: tuple[str, ...] = ()
) -> DataFrame:
    """Insert or replace on ``key``; a replaced row takes every column of the update, NULLs too.

    Of several updates of a key the last by ``order`` wins; without one, ``default_order`` decides.
    Columns that only the updates have come after the target's and are NULL in untouched rows; those
    the updates lack are NULL in the rows they write. Columns of ``order`` that the target does not
    have are no data and go.
    """
    last = latest_per_key(updates, key, order or default_order(updates, key))
    last = last.drop(*[c for c in order if c not in target.columns])
    untouched = target.join(last.select(*key), list(key), "left_anti")
    return untouched.select(*target.columns).unionByName(last, allowMissingColumns=True)


def merge_entity(
    target: DataFrame, updates: DataFrame, entity: Entity, order: tuple[str, ...] = ()
) -> DataFrame:
    return merge_rows(target, updates, entity.key, order)


PROGRESS_KEY = ("run_id", "entity")

# name of the state -> the wanted one of its (seq, value) pairs, largest or smallest ``seq``
_PROGRESS_STATES = {
    "last": F.max, "began": F.min, "ended": F.max, "page": F.max, "items": F.max, "error": F.max,
    "first_at": F.min, "last_at": F.max,
}


def progress_states(events: DataFrame) -> DataFrame:
    """What progress rows need to know of status updates (``seq`` order), per run and entity.

    Every state is one (seq, value) pair: the first or the last of its kind. States of any two sets of
    events combine to those of their union, so neither the order nor a repeat of batches matters.
    """

    def pair(value: str, when=None):
        found = F.col(value).isNotNull() if when is None else when
        return F.when(found, F.struct("seq", F.col(value).alias("value")))

    pairs = {
        "last": pair("status"),
        "began": pair("at", F.col("status") == "running"),
        "ended": pair("at", F.col("status").isin("completed", "failed")),
        "page": pair("page_offset"),
        "items": pair("items_processed"),
        "error": pair("error_message"),
        "first_at": pair("at"),
        "last_at": pair("at"),
    }
    return events.groupBy(*PROGRESS_KEY).agg(*[_PROGRESS_STATES[n](c).alias(n) for n, c in pairs.items()])


def combine_progress(states: DataFrame) -> DataFrame:
    """One row of states per run and entity; a NULL state gives way to a known one."""
    return states.groupBy(*PROGRESS_KEY).agg(*[pick(n).alias(n) for n, pick in _PROGRESS_STATES.items()])


def progress_rows(states: DataFrame) -> DataFrame:
    """Progress rows of combined states.

    The status is the last one; ``started_at`` is set once, by the first ``running``;
    ``completed_at`` by the last ``completed`` or ``failed``; an update that leaves a number or
    message out keeps the stored one.
    """
    return states.select(
        *PROGRESS_KEY,
        F.col("last.value").alias("status"),
        F.col("began.value").alias("started_at"),
        F.col("ended.value").alias("completed_at"),
        F.coalesce("page.value", F.lit(0)).alias("last_page_offset"),
        F.coalesce("items.value", F.lit(0)).alias("total_items_processed"),
        F.col("error.value").alias("error_message"),
        F.col("first_at.value").alias("created_at"),
        F.col("last_at.value").alias("updated_at"),
    )


def merge_progress(events: DataFrame) -> DataFrame:
    """Progress rows after a sequence of status updates per run and entity."""
    return progress_rows(progress_states(events))


CHECKPOINT_KEY = ("run_id", "entity", "checkpoint_type")


def newest_checkpoints(saved: DataFrame) -> DataFrame:
    """The newest checkpoint of each run, entity and type, by ``created_at`` and ``seq``; combines like states."""
    return latest_per_key(saved, CHECKPOINT_KEY, ("created_at", "seq"))


def fold_run_log(events: DataFrame) -> DataFrame:
    """Run rows from start and end events.

    A run has one start and as many ends as it was closed, normally one; their notes are joined
    by line breaks, which makes the text as long as the result demands.
    """
    is_start = F.col("kind") == "start"
    is_end = F.col("kind") == "end"
    ended = F.max_by(F.struct("success", "at"), F.when(is_end, F.col("seq")))
    ordered = F.array_sort(F.collect_list(F.struct("seq", "notes")))
    runs = events.groupBy("run_id").agg(
        F.min_by("at", F.when(is_start, F.col("seq"))).alias("started_at"),
        ended.alias("_end"),
        ordered.alias("_notes"),
    )
    status = (
        F.when(F.col("_end").isNull(), "running")
        .when(F.col("_end.success"), "success")
        .otherwise("error")
    )
    return runs.select(
        F.col("run_id").alias("id"),
        "started_at",
        F.col("_end.at").alias("finished_at"),
        status.alias("status"),
        F.array_join("_notes.notes", "\n").alias("notes"),
    )


def retain_runs(runs: DataFrame, as_of: str, days: int) -> DataFrame:
    """Runs that did not start more than ``days`` before ``as_of``; a run without a start stays."""
    cutoff = F.expr(f"TIMESTAMP_NTZ'{as_of}'") - F.expr(f"INTERVAL {int(days)} DAYS")
    return runs.filter(F.col("started_at").isNull() | (F.col("started_at") >= cutoff))


def retain_children(child: DataFrame, kept_runs: DataFrame) -> DataFrame:
    """Child rows whose run is kept."""
    return child.join(kept_runs.select(F.col("id").alias("run_id")), "run_id", "left_semi")
