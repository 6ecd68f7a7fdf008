"""Loading entities in parent-first order, with a log of the run, and going on after an interruption."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.operators.flatten import good_rows, reached_since, with_reason
from clientele.operators.merge import default_order, latest_per_key
from clientele.plans.run_store import RunStore, append_metrics, now
from clientele.plans.specs import ENTITIES, LOAD_ORDER, Entity
from clientele.session import few_rows, session_settings
from clientele.sources.versions import VersionedTable, drop_path, path_exists, stored_bytes

__all__ = [
    "LoadFailed", "append_metrics", "in_load_order", "load_entity", "ordered_load", "require_loaded", "resume_load", "upsert",
]

#: Staged rows lie in so many parts by a hash of their key; a first load takes as many of them at once as
#: hold about ``AT_ONCE`` bytes, so that what it shuffles at a time is a fraction of the entity.
SLICES = 8
AT_ONCE = 64 << 20
#: Folders of a stage: whether its rows outlast the load, and their part.
LAID_OUT = ("_lasting", "_slice")
#: One open file per folder of a stage, in small row groups, in place of a sort; shuffles go with the job they are for.
STAGING = {"spark.sql.maxConcurrentOutputFileWriters": str(2 * SLICES)}
LOADING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

MANIFEST = "position int, entity string, status string, rows bigint, rejected bigint, detail string"


def upsert(spark: SparkSession, path: str, key: tuple[str, ...], rows: DataFrame) -> None:
    """Insert or replace rows of a stored metadata table, so that a repeated run leaves one per key."""
    table = VersionedTable(spark, path, key)
    if table.version:
        table.merge(rows)
    else:
        table.replace(rows)


def in_load_order(names: list[str] | None) -> list[Entity]:
    """The chosen entities, parents first; an unknown name is an error."""
    if names is None:
        return list(LOAD_ORDER)
    unknown = [n for n in names if n not in ENTITIES]
    if unknown:
        raise ValueError(f"unknown entities: {', '.join(unknown)}")
    return [e for e in LOAD_ORDER if e.name in names]


def _counts(staged: DataFrame, since: str | None) -> tuple:
    """Aggregates over staged rows: those to load and those rejected."""
    good = F.col("reason").isNull()
    wanted = good & reached_since(staged, since) if since else good
    return F.count_if(wanted).alias("loaded"), F.count_if(~good).alias("rejected")


def _stage(marked: DataFrame, key: tuple[str, ...], folder: str, since: str | None) -> tuple[int, int]:
    """Write the typed rows and count them on the way."""
    seen = Observation()
    plain = F.col("reason").isNull() & (F.size("unread") == 0)
    of_row = (F.when(plain, 0).otherwise(1), F.pmod(F.xxhash64(*key), F.lit(SLICES)).cast("int"))
    laid_out = marked.observe(seen, *_counts(marked, since)).withColumns(dict(zip(LAID_OUT, of_row)))
    options = {"compression": "zstd", "parquet.block.size": str(16 << 20), "partitionOverwriteMode": "static"}
    with session_settings(marked.sparkSession, STAGING):
        laid_out.write.mode("overwrite").options(**options).partitionBy(*LAID_OUT).parquet(folder)
    return seen.get["loaded"], seen.get["rejected"]


def _read_stage(marked: DataFrame, folder: str) -> DataFrame:
    """The staged rows and where they lie; one without such folders, from an older release, counts as slice 0."""
    places = [T.StructField(name, T.IntegerType()) for name in LAID_OUT]
    staged = marked.sparkSession.read.schema(T.StructType([*marked.schema, *places])).parquet(folder)
    return staged.withColumn("_slice", F.coalesce("_slice", F.lit(0)))


def _clear_stage(spark: SparkSession, folder: str) -> None:
    """Remove the staged rows that are nothing but a copy of the table's: good ones, with all values read.

    The others stay. What is left is no whole stage, so its mark of success goes first.
    """
    if not path_exists(spark, f"{folder}/_lasting=0"):
        return
    drop_path(spark, f"{folder}/_SUCCESS")
    if not path_exists(spark, f"{folder}/_lasting=1"):
        # The folder can still be read as a table, of no rows.
        layout = spark.read.parquet(folder).drop(*LAID_OUT).schema
        none = spark.createDataFrame([], layout).coalesce(1).write.mode("append")
        none.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{folder}/_lasting=1/_slice=0")
    drop_path(spark, f"{folder}/_lasting=0")


def _stage_folder(store: str, entity: str, run_id: int | None) -> str:
    return f"{store}/staged/{entity}/{uuid.uuid4().hex if run_id is None else f'run-{run_id}'}"


def load_entity(
    spark: SparkSession, store: str, entity: Entity, records: DataFrame, since: str | None = None,
    run_id: int | None = None, resume: bool = False,
) -> tuple[int, int]:
    """Flatten, filter, merge and switch to the new version; (loaded, rejected) counts.

    ``records`` has ``raw`` and ``seq``, the arrival order that ``ingest_pages`` gives; the last
    record of a key is merged. Without ``seq`` the newest, then the greatest payload counts as last.
    The typed rows are staged as Parquet first: the payloads are parsed once although the merge
    reads them twice, and the rejected ones stay there with their reason, as do, in ``unread``, the
    values of good ones that do not fit their type; the other rows go from there once they are in
    the table, with ``run_id`` when ``ordered_load`` has logged that. A first load takes the rows by
    slices of their keys, see ``SLICES``, and switches to the table when all are written.

    The new version carries ``run_id`` as its commit token. With ``resume`` a table that has the
    run's token is left as it is, and rows that the run has staged completely are not parsed again.
    """
    arrival = ("seq",) if "seq" in records.columns else ()
    folder = _stage_folder(store, entity.name, run_id)
    marked = with_reason(records, entity, keep=arrival, unread=True)
    if resume and path_exists(spark, f"{folder}/_SUCCESS"):
        loaded, rejected = _read_stage(marked, folder).agg(*_counts(marked, since)).first()
    else:
        loaded, rejected = _stage(marked, entity.key, folder, since)
    table = VersionedTable(spark, f"{store}/{entity.name}", entity.key)
    if resume and run_id is not None and table.last_tag() == run_id:
        return loaded, rejected
    staged = good_rows(_read_stage(marked, folder))
    if since:
        staged = staged.filter(reached_since(staged, since))
    fresh = staged.drop(*LAID_OUT)
    order = arrival or default_order(fresh, entity.key)
    if table.version:
        table.merge(fresh, order, tag=run_id)
    else:
        steps = min(SLICES, 1 + stored_bytes(spark, folder) // AT_ONCE)
        slices = [staged.filter(F.col("_slice").isin(*range(i, SLICES, steps))).drop(*LAID_OUT) for i in range(steps)]
        table.replace(*[latest_per_key(rows, entity.key, order).drop(*arrival) for rows in slices], tag=run_id)
    if run_id is None:
        _clear_stage(spark, folder)
    return loaded, rejected


def ordered_load(
    spark: SparkSession,
    store: str,
    sources: Mapping[str, DataFrame],
    entities: list[str] | None = None,
    *,
    since: str | None = None,
    continue_on_error: bool = False,
    dry_run: bool = False,
    page_size: int = 1000,
    run_id: int | None = None,
) -> DataFrame:
    """Load the chosen entities; returns a manifest with one row per entity tried.

    A dry run writes nothing and counts what the first page of each entity would process. With
    ``run_id`` the load is logged below ``store`` while it goes on, see ``RunStore``: all entities as
    pending, each one as running and then completed or failed, a checkpoint per completed one. A
    load that dies can be taken up by ``resume_load``.
    """
    chosen = in_load_order(entities)
    if dry_run:
        rows = [(i, e.name, "dry run", sources[e.name].limit(page_size).count(), 0, None) for i, e in enumerate(chosen)]
        return few_rows(spark, rows, MANIFEST)
    log = None if run_id is None else RunStore(spark, store)
    if log is not None:
        log.log_run(run_id, "start", None, ", ".join(e.name for e in chosen))
        seq = log.next_seq(run_id)
        log.log_progress([_update(run_id, seq + i, e.name, "pending") for i, e in enumerate(chosen)])
    return _load_all(spark, store, sources, chosen, since, continue_on_error, log, run_id, resume=False)


def resume_load(
    spark: SparkSession,
    store: str,
    sources: Mapping[str, DataFrame],
    run_id: int | None = None,
    *,
    since: str | None = None,
    continue_on_error: bool = False,
) -> DataFrame:
    """Go on with a run: its entities that are not completed, parents first, under the same run id.

    Without ``run_id`` the latest run is taken that was started and not ended; nothing to resume
    gives an empty manifest. The log is settled first, so what a dead process wrote last counts. A
    table that was committed before its completion was logged is recognised by its commit token.
    """
    log = RunStore(spark, store)
    # Runs that died have not been settled yet; those that ended are settled already.
    unsettled = [run_id] if run_id is not None else [r.id for r in log.run_log().filter("status = 'running'").select("id").collect()]
    for run in unsettled:
        log.settle(run)
    run_id = log.interrupted_run() if run_id is None else run_id
    left = [] if run_id is None else log.left_to_do(run_id)
    if not left:
        return few_rows(spark, [], MANIFEST)
    return _load_all(spark, store, sources, in_load_order(left), since, continue_on_error, log, run_id, resume=True)


class LoadFailed(RuntimeError):
    """A load whose manifest names failed entities, where the caller needs all of them."""


def require_loaded(manifest: DataFrame) -> None:
    """Raise with what every failed entity reported, so that nothing is read from tables that are not whole."""
    # One row per entity tried.
    failed = manifest.filter("status = 'failed'").orderBy("position").collect()
    if failed:
        raise LoadFailed("; ".join(f"{r.entity}: {r.detail}" for r in failed))


def _update(run_id: int, seq: int, entity: str, status: str, items=None, rejected=None, ms=None, error=None) -> tuple:
    return run_id, seq, entity, status, now(), None, items, rejected, ms, error


def _load_all(
    spark: SparkSession, store: str, sources: Mapping[str, DataFrame], chosen: list[Entity], since: str | None,
    continue_on_error: bool, log: RunStore | None, run_id: int | None, resume: bool,
) -> DataFrame:
    """One entity after the other; the status updates that are due are written together before the next one."""
    manifest: list[tuple] = []
    due: list[tuple] = []
    seq = 0 if log is None else log.next_seq(run_id)

    def report(*updates: tuple) -> None:
        nonlocal seq
        for entity, status, *more in updates:
            due.append(_update(run_id, seq, entity, status, *more))
            seq += 1

    def write_due() -> None:
        log.log_progress(due)
        for _, _, name, status, *_ in due:
            if status == "completed":
                _clear_stage(spark, _stage_folder(store, name, run_id))
        due.clear()

    for position, entity in enumerate(chosen):
        clock = time.monotonic()
        if log is not None:
            report((entity.name, "running"))
            write_due()
        try:
            with session_settings(spark, LOADING):
                rows, rejected = load_entity(spark, store, entity, sources[entity.name], since, run_id, resume)
            row = (position, entity.name, "loaded", rows, rejected, None)
        except Exception as error:  # reported in the manifest, as the caller chose to go on or stop
            row = (position, entity.name, "failed", 0, 0, f"{type(error).__name__}: {error}")
        manifest.append(row)
        ms = int(1000 * (time.monotonic() - clock))
        if row[2] == "failed":
            report((entity.name, "failed", None, None, ms, row[5]))
            if not continue_on_error:
                break
        elif log is not None:
            report((entity.name, "completed", row[3], row[4], ms))
    if log is not None:
        write_due()
        failed = [m for m in manifest if m[2] == "failed"]
        done = len(manifest) - len(failed)
        log.settle(run_id)
        log.log_run(run_id, "end", not failed, f"{done}/{len(chosen)} entities, {sum(m[3] for m in manifest)} rows")
    return few_rows(spark, manifest, MANIFEST)
