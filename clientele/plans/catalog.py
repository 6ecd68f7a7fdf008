"""Every registered query: name -> function of (spark, folder of the given tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.operators import checks, compare, contacts, digest, files, flatten, merge, runs
from clientele.plans import load, retention, run_store, validation
from clientele.plans.specs import ALLOWED_VALUES, ENTITIES, LOAD_ORDER, META_KEYS
from clientele.session import use_utc, work_dir
from clientele.sources import exports, pages, tables as scans
from clientele.sources.bindings import CrmTables
from clientele.sources.raw_records import defective_records, raw_records
from clientele.sources.versions import VersionedTable
from clientele.streaming.incremental import IncrementalLoad

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def present(df: DataFrame) -> DataFrame:
    """Results in types any engine can compare: decimals as doubles, nested values as JSON."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            col = F.to_json(col)
        elif isinstance(f.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            col = col.cast("bigint")
        out.append(col.alias(f.name))
    return df.select(*out)


def query(name: str):
    def register(build: Callable[[CrmTables], DataFrame]) -> Callable[[CrmTables], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(build(CrmTables(use_utc(spark), sf_dir)))

        QUERIES[name] = run
        return build

    return register


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# --- sources and sinks -----------------------------------------------------------------


@query("ingest_pages")
def _(t):
    """Contacts landed as pages: half under an envelope, half as bare lists, some unknown."""
    folder = work_dir(t.spark, "landing")
    records = raw_records(t, "contacts")
    enveloped = pages.to_pages(records.filter("id % 2 = 0"), "contacts")
    bare = pages.to_pages(records.filter("id % 2 = 1"), None)
    unknown = pages.to_pages(records, "other")
    enveloped.unionByName(bare).unionByName(unknown).write.text(folder)
    rows = pages.ingest_pages(t.spark, folder)
    return flatten.flatten(rows, ENTITIES["contacts"]).select("id", "given_name", "company_id", "tag_ids")


@query("exact_numbers")
def _(t):
    """Orders landed with amounts of 26 digits, zeros at the end included; the record's text and its typed fields."""
    folder = work_dir(t.spark, "landing")
    amount = F.col("o_totalprice").cast("decimal(15,2)")
    record = F.concat(
        F.lit('{"id":'), F.col("o_orderkey"), F.lit(',"total":'), amount, F.lit(',"currency":"at 1.50","custom_fields":[{"id":1,"rate":'),
        amount.cast("decimal(38,20)"), F.lit('}]}'),
    )
    landed = t.star("orders").select(F.col("o_orderkey").alias("id"), record.alias("raw"))
    pages.to_pages(landed, "orders").write.text(folder)
    rows = flatten.flatten(pages.ingest_pages(t.spark, folder), ENTITIES["orders"])
    return rows.select("id", "raw", F.col("total").cast("string").alias("total"), "currency", "custom_fields")


@query("scan_entity")
def _(t):
    return scans.scan_entity(t["contacts"], "owner_id > 50 AND country_code = 'CA'", 500)


@query("json_payload_column")
def _(t):
    rows = t["stages"].select("id", "name").unionByName(t["tags"].select("id", "name"))
    stamped = t["opportunities"].select("id", "name", "created_at")
    payload = flatten.json_payload(stamped).select("id", "raw")
    return payload.unionByName(flatten.json_payload(rows).select("id", "raw"))


@query("export_csv")
def _(t):
    """Notes written as CSV and read back; bodies hold commas, quotes and line breaks."""
    notes = t["notes"].select("id", "contact_id", "title", "body", "created_at")
    folder = work_dir(t.spark, "csv")
    exports.export_csv(notes, folder)
    return exports.read_csv_export(t.spark, folder, notes.schema)


@query("export_parquet")
def _(t):
    """Contacts written as Parquet with structured lists, then read back."""
    folder = work_dir(t.spark, "parquet")
    exports.export_parquet(t["contacts"].select("id", "email", "tag_ids", "email_addresses"), folder)
    back = t.spark.read.parquet(folder)
    return back.select(
        "id", "email", F.size("tag_ids").alias("tags"), F.element_at("tag_ids", 1).alias("first_tag"),
        F.get("email_addresses", F.lit(0)).getField("field").alias("first_label"),
    )


def _all_tables(t: CrmTables) -> dict[str, Callable[[], DataFrame]]:
    return {e.name: (lambda n=e.name: t[n]) for e in LOAD_ORDER}


@query("export_all")
def _(t):
    out = work_dir(t.spark, "export")
    return exports.export_all(t.spark, _all_tables(t), out, "parquet").select(
        "table_name", "format", "status", "rows"
    )


# --- flattening ------------------------------------------------------------------------


def _register_flatten(name: str, entity: str) -> None:
    @query(name)
    def _(t):
        return flatten.flatten(raw_records(t, entity), ENTITIES[entity]).drop("raw")


for _entity in LOAD_ORDER:
    _register_flatten(f"flatten_{_entity.name}", _entity.name)


@query("flatten_base")
def _(t):
    """The default projection: id, dates and the payload."""
    base = ENTITIES["pipelines"]
    rows = flatten.flatten(raw_records(t, "users"), base)
    return rows.select("id", "created_at", "updated_at", F.get_json_object("raw", "$.email_address").alias("raw_email"))


@query("parse_timestamps")
def _(t):
    texts = raw_records(t, "opportunities").select(
        "id", F.get_json_object("raw", "$.date_created").alias("text")
    )
    return flatten.parse_timestamps(texts, "text", "parsed")


@query("quarantine_bad_records")
def _(t):
    return flatten.load_outcome(defective_records(t, "contacts"), ENTITIES["contacts"])


# --- filters ---------------------------------------------------------------------------


@query("delta_since")
def _(t):
    return flatten.delta_since(t["contacts"], "2023-09-01T00:00:00Z").select("id", "created_at", "updated_at")


@query("where_clause_export")
def _(t):
    folder = work_dir(t.spark, "where")
    chosen = scans.scan_entity(t["opportunities"], "value > 100000 AND status = 'O'")
    exports.export_csv(chosen, folder)
    return exports.read_csv_export(t.spark, folder, chosen.schema).select("id", "contact_id", "value")


@query("search_contacts")
def _(t):
    return scans.search_contacts(t["contacts"], "mach", 200).select("id", "given_name", "family_name", "email")


@query("search_companies")
def _(t):
    return scans.search_companies(t["companies"], "nation_1").select("id", "name", "website")


@query("lookup_record")
def _(t):
    return scans.lookup_record(t["contacts"], 77).select("id", "given_name", "email", "created_at")


@query("missing_company_name")
def _(t):
    return checks.missing_company_name(t["companies"]).orderBy("id").limit(100)


@query("missing_contact_names")
def _(t):
    return checks.missing_contact_names(t["contacts"]).orderBy("id").limit(100)


@query("json_shape_check")
def _(t):
    return checks.json_shape_check(t["contacts"]).orderBy("id").limit(100)


@query("large_files")
def _(t):
    return files.large_files(t["contact_files"], 10)


@query("files_by_type")
def _(t):
    return files.files_by_type(t["contact_files"], "fr")


@query("allowed_values_check")
def _(t):
    """Rows outside the enumerations, per table and column; 'done' is not a progress status."""
    changed = t["progress"].withColumn(
        "status", F.when(F.col("status") == "completed", "done").otherwise(F.col("status"))
    )
    source = {"run_log": t["run_log"], "progress": changed, "checkpoints": t["checkpoint_events"]}
    parts = []
    for (table, column), allowed in ALLOWED_VALUES.items():
        bad = checks.allowed_values_check(source[table], column, allowed)
        count = bad.agg(F.count("*").alias("bad_rows"))
        parts.append(count.select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "bad_rows"))
    return checks.union_all(parts)


# --- joins -----------------------------------------------------------------------------


@query("contacts_with_relationships")
def _(t):
    return contacts.contacts_with_relationships(t)


@query("contact_analytics")
def _(t):
    return contacts.contact_analytics(t)


@query("contact_analytics_fanout")
def _(t):
    return contacts.contact_analytics(t, fanout=True).select(
        "contact_id", "opportunity_count", "task_count", "note_count", "tag_count",
        "total_opportunity_value",
    )


SEED = "spot-check"


@query("spot_check_counts")
def _(t):
    return contacts.spot_check_counts(t, SEED)


@query("random_sample")
def _(t):
    return contacts.random_sample(t["contacts"], SEED).select("id", "given_name", "family_name")


@query("files_with_contacts")
def _(t):
    return files.files_with_contacts(t["contact_files"], t["contacts"])


def _file_split(t: CrmTables) -> tuple[DataFrame, DataFrame]:
    """Files of some source systems as known; the incoming batch lists all files again."""
    every = t["contact_files"]
    return every.filter("file_path < '/store/src15'"), every


@query("new_files_only")
def _(t):
    known, incoming = _file_split(t)
    return files.new_files_only(incoming, known).select("id", "contact_id", "file_hash")


@query("stage_pipeline_mismatch")
def _(t):
    found = checks.stage_pipeline_mismatch(t["opportunities"], t["stages"])
    return found.orderBy("opportunity_id").limit(100)


@query("explode_contact_emails")
def _(t):
    return flatten.contact_emails(t["contacts"])


@query("tag_links")
def _(t):
    return flatten.tag_links(t["contacts"])


@query("interrupted_runs")
def _(t):
    return runs.interrupted_runs(t["run_log"], t["progress"])


@query("last_successful_run")
def _(t):
    return runs.last_successful_run(t["run_log"], t["progress"])


@query("snapshot_delta")
def _(t):
    return runs.snapshot_delta(t["snapshots"])


@query("table_diff")
def _(t):
    """Contacts against an older version: some mails changed, some cities unset, some rows gone."""
    now = t["contacts"]
    old = now.filter("id % 97 != 5").withColumns(
        {
            "email": F.expr("CASE WHEN id % 17 = 0 THEN concat('old.', email) ELSE email END"),
            "city": F.expr("CASE WHEN id % 19 != 0 THEN city END"),
        }
    )
    return compare.table_diff(old, now, ENTITIES["contacts"]).filter(
        "field NOT IN ('created_at', 'updated_at')"
    )


# --- referential validation ------------------------------------------------------------

# check -> (child table, foreign keys tested, all if empty)
ORPHAN_CHECKS: dict[str, tuple[str, tuple[str, ...]]] = {
    "orphan_contact_tags": ("contact_tags", ()),
    "orphan_contacts": ("contacts", ()),
    "orphan_opportunities": ("opportunities", ()),
    "opps_missing_stage": ("opportunities", ("stage_id",)),
    "opps_missing_pipeline": ("opportunities", ("pipeline_id",)),
    "orphan_tasks": ("tasks", ()),
    "tasks_missing_parents": ("tasks", ("contact_id", "opportunity_id")),
    "orphan_notes": ("notes", ()),
    "notes_missing_parents": ("notes", ("contact_id", "opportunity_id")),
    "orphan_orders": ("orders", ()),
    "orphan_order_items": ("order_items", ()),
    "orphan_payments": ("payments", ()),
    "orphan_stages": ("stages", ()),
}


def _register_orphans(name: str, entity: str, columns: tuple[str, ...]) -> None:
    @query(name)
    def _(t):
        found = checks.orphan_count(t, checks.OrphanCheck(ENTITIES[entity], columns))
        return checks.labelled(found, name, "check_name")


for _name, (_child, _columns) in ORPHAN_CHECKS.items():
    _register_orphans(_name, _child, _columns)


@query("fk_report")
def _(t):
    return checks.fk_report(t)


# Rows taken away, so that every reference of the report has orphans.
THINNED = {
    "contacts": "id % 50 != 3", "tags": "id % 9 != 4", "orders": "id % 40 != 5", "products": "id % 30 != 7",
    "pipelines": "id != 2", "opportunities": "id % 70 != 8", "companies": "id % 5 != 1",
}


@query("fk_report_thinned")
def _(t):
    """The report over tables that have lost some of their rows."""
    names = {*checks.FK_REPORT, *THINNED, "users"}
    return checks.fk_report({n: t[n].filter(THINNED[n]) if n in THINNED else t[n] for n in names})


@query("orphan_note_samples")
def _(t):
    return checks.orphan_note_samples(t)


@query("dashboard_checks")
def _(t):
    return checks.dashboard_checks(t)


@query("validation_summary")
def _(t):
    return validation.validation_summary(t)


@query("not_null_report")
def _(t):
    return checks.not_null_report(t, list(LOAD_ORDER))


def _table_keys() -> dict[str, tuple[str, ...]]:
    return {e.name: e.key for e in LOAD_ORDER}


@query("key_uniqueness_report")
def _(t):
    keys = _table_keys() | {n: META_KEYS[n] for n in META_KEYS if n != "checkpoints"}
    return checks.key_uniqueness_report(t, keys)


# --- aggregations ----------------------------------------------------------------------


@query("freshness_counts")
def _(t):
    return contacts.freshness_counts(t).orderBy("tbl")


@query("union_checks")
def _(t):
    """All labelled counts of the validation pack under one heading."""
    return validation.issue_counts(t).drop("failed")


@query("order_reconciliation")
def _(t):
    return checks.worst_reconciled(t["orders"], t["order_items"])


@query("overpaid_orders")
def _(t):
    return checks.most_overpaid(t["orders"], t["payments"])


@query("duplicate_emails")
def _(t):
    return contacts.duplicate_emails(t["contacts"])


@query("duplicate_exact_emails")
def _(t):
    return checks.duplicate_exact_emails(t["contacts"])


@query("coverage_totals")
def _(t):
    return contacts.coverage_totals(t)


@query("coverage_distinct")
def _(t):
    return contacts.coverage_distinct(t)


@query("entity_counts")
def _(t):
    return contacts.entity_counts(t)


@query("run_metrics")
def _(t):
    return runs.run_metrics(t["run_log"], t["request_log"])


@query("entity_performance")
def _(t):
    found = runs.entity_performance(t["request_metrics"])
    return rounded(found, "avg_page_duration_ms", "throughput_items_per_second")


@query("run_performance_summary")
def _(t):
    latest = runs.for_run(t["request_metrics"], None, t["run_log"])
    found = runs.run_performance_summary(runs.entity_performance(latest))
    return rounded(found, "avg_page_duration_ms", "throughput_items_per_second")


@query("throttle_analysis")
def _(t):
    found = runs.throttle_analysis(t["throttle_events"], ("run_id",))
    return rounded(found, "avg_throttle_remaining")


@query("error_analysis")
def _(t):
    return runs.error_analysis(t["error_events"], ("run_id",))


@query("file_stats")
def _(t):
    return files.file_stats(t["contact_files"])


@query("contact_file_summary")
def _(t):
    return files.contact_file_summary(t["contact_files"])


@query("table_digest")
def _(t):
    return digest.table_digests(t, {"orders": ("id",), "contact_tags": ("contact_id", "tag_id")})


@query("snapshot_all")
def _(t):
    return digest.snapshot_all(t, _table_keys(), t["run_log"])


SNAPPED = ("users", "contacts", "opportunities", "products")


def _snapshots_of_two_loads(t: CrmTables) -> DataFrame:
    """Tables loaded in two overlapping parts, with a snapshot after either; a load that fails ends it."""
    store = work_dir(t.spark, "store")
    log = run_store.RunStore(t.spark, store)
    for run_id, part in ((1, "id % 3 < 2"), (2, "id % 3 > 0")):
        sources = {n: raw_records(t, n).filter(part).selectExpr("raw", "id AS seq") for n in SNAPPED}
        load.require_loaded(load.ordered_load(t.spark, store, sources, list(SNAPPED)))
        log.take_snapshot(run_id, {n: VersionedTable(t.spark, f"{store}/{n}") for n in SNAPPED})
    return log.snapshots()


@query("stored_snapshots")
def _(t):
    """Snapshots kept by two runs, with their rank per table, newest first."""
    kept = _snapshots_of_two_loads(t)
    return kept.join(runs.rank_snapshots(kept).drop("row_count"), ["table_name", "run_id"])


@query("stored_snapshot_delta")
def _(t):
    return runs.snapshot_delta(_snapshots_of_two_loads(t))


@query("file_sync_totals")
def _(t):
    known, incoming = _file_split(t)
    return files.file_sync_totals(incoming, known)


@query("source_vs_loaded")
def _(t):
    return runs.source_vs_loaded(t["source_counts"], contacts.entity_counts(t, ("contacts", "companies", "orders", "users", "tasks")))


# --- windows, sorts, limits ------------------------------------------------------------


@query("rank_snapshots")
def _(t):
    return runs.rank_snapshots(t["snapshots"])


@query("latest_per_key")
def _(t):
    last = merge.latest_per_key(t["progress_events"], ("run_id", "entity"), ("at", "seq"))
    return last.select("run_id", "entity", "seq", "status")


@query("latest_checkpoint")
def _(t):
    return runs.latest_checkpoint(t["checkpoint_events"])


@query("recent_runs")
def _(t):
    return runs.recent_runs(t["run_log"])


@query("run_durations")
def _(t):
    return runs.run_durations(t["run_log"])


@query("request_metrics_for_run")
def _(t):
    return runs.request_metrics_for_run(runs.for_run(t["request_metrics"], None, t["run_log"]))


@query("system_health_for_run")
def _(t):
    return runs.system_health_for_run(runs.for_run(t["system_health"], None, t["run_log"]))


@query("browse_entity")
def _(t):
    return scans.browse_entity(t["opportunities"], 100).select("id", "name", "value", "created_at")


@query("entities_to_resume")
def _(t):
    """What is left to do in the run that was interrupted last."""
    run = runs.interrupted_runs(t["run_log"], t["progress"]).select(F.col("id").alias("run_id"))
    left = t["progress"].join(F.broadcast(run), "run_id", "left_semi")
    return runs.entities_to_resume(left)


# --- writes ----------------------------------------------------------------------------


def _order_versions(t: CrmTables) -> tuple[DataFrame, DataFrame]:
    """Opportunities of two years ago as the stored table, later ones plus changes as updates."""
    every = t["opportunities"].select("id", "contact_id", "name", "value", "status", "created_at")
    stored = every.filter("created_at < TIMESTAMP_NTZ'1997-01-01'")
    updates = every.filter("created_at >= TIMESTAMP_NTZ'1996-07-01'").withColumns(
        {
            "status": F.expr("CASE WHEN id % 5 = 0 THEN NULL ELSE 'X' END"),
            "value": F.expr("value + 1"),
        }
    )
    twice = updates.withColumn("seq", F.lit(1)).unionByName(
        updates.filter("id % 3 = 0").withColumns({"status": F.lit("Y"), "seq": F.lit(2)})
    )
    return stored, twice


@query("merge_entity")
def _(t):
    stored, updates = _order_versions(t)
    return merge.merge_entity(stored, updates, ENTITIES["opportunities"], ("seq",))


@query("merge_new_column")
def _(t):
    """A stored table that gets a column by a merge: rows it replaces or adds have it, all others NULL."""
    stored, updates = _order_versions(t)
    table = VersionedTable(t.spark, work_dir(t.spark, "widened"), part_width=20_000)
    table.replace(stored)
    table.merge(updates.withColumn("source", F.concat(F.lit("import "), F.col("seq"))), ("seq",))
    return table.current()


@query("merge_contact_tags")
def _(t):
    links = t["contact_tags"].withColumn("source", F.lit("bought"))
    listed = flatten.tag_links(t["contacts"]).withColumn("source", F.lit("listed"))
    return merge.merge_entity(links, listed, ENTITIES["contact_tags"])


@query("merge_files")
def _(t):
    known, every = _file_split(t)
    first = merge.latest_per_key(known, files.FILE_KEY, ("created_at", "id"))
    batch = every.withColumns({"seq": F.col("id"), "at": F.expr("created_at + INTERVAL 1 DAY")})
    return files.merge_files(first, batch)


@query("merge_source_counts")
def _(t):
    stored = t["source_counts"]
    again = stored.filter("run_id > 15").withColumn("items_retrieved", F.col("items_retrieved") + 7)
    return merge.merge_rows(stored, again, META_KEYS["source_counts"])


def _in_batches(t: CrmTables, label: str, events: DataFrame, key, states, combine) -> DataFrame:
    """Events folded into a stored table in three batches that are not in order, one of them twice."""
    table = VersionedTable(t.spark, work_dir(t.spark, label), key, part_width=8)
    for batch in ("seq % 3 = 2", "seq % 3 = 0", "seq % 3 = 2", "seq % 3 = 1"):
        run_store.fold_into(table, states(events.filter(batch)), combine)
    return table.current()


@query("merge_progress")
def _(t):
    """Status updates folded batch by batch into stored states."""
    stored = _in_batches(
        t, "progress", t["progress_events"], merge.PROGRESS_KEY, merge.progress_states, merge.combine_progress
    )
    return merge.progress_rows(stored)


@query("stored_checkpoints")
def _(t):
    """Checkpoints folded batch by batch; the newest of a key stays, in whatever order batches come."""
    columns = ("run_id", "entity", "checkpoint_type", "checkpoint_data", "created_at", "seq")
    newest = merge.newest_checkpoints
    stored = _in_batches(
        t, "checkpoints", t["checkpoint_events"].select(*columns), merge.CHECKPOINT_KEY, newest, newest
    )
    return stored.drop("seq")


@query("merge_checkpoints")
def _(t):
    saved = t["checkpoint_events"]
    columns = ["run_id", "entity", "checkpoint_type", "checkpoint_data", "created_at", "seq"]
    early = merge.latest_per_key(
        saved.filter("seq % 2 = 0").select(*columns), META_KEYS["checkpoints"], ("created_at", "seq")
    )
    merged = merge.merge_rows(
        early, saved.filter("seq % 2 = 1"), META_KEYS["checkpoints"], ("created_at", "seq")
    )
    return merged.drop("seq")


@query("run_log_fold")
def _(t):
    return merge.fold_run_log(t["run_events"])


@query("append_metrics")
def _(t):
    """Throttle and error rows appended in two steps; rows per run read back from the store."""
    store = work_dir(t.spark, "metrics")
    rows = t["throttle_events"].select("run_id", "entity", "endpoint", "throttle_remaining")
    load.append_metrics(rows, store)
    errors = t["error_events"].select("run_id", "entity", "endpoint", F.lit(None).cast("bigint").alias("throttle_remaining"))
    load.append_metrics(errors, store)
    back = t.spark.read.parquet(store)
    return back.groupBy(F.col("run_id").cast("bigint").alias("run_id"), "entity").agg(
        F.count("*").alias("rows"), F.sum("throttle_remaining").alias("remaining")
    )


@query("retention")
def _(t):
    """Rows kept and removed per stored table when runs older than 15 days go; kept ones are counted after it."""
    store = work_dir(t.spark, "runs")
    names = ("request_log", "source_counts", "snapshots", "throttle_events", "progress", "run_log")
    for name in names:
        rows = t[name].withColumnRenamed("id", "run_id") if name == "run_log" else t[name]
        load.append_metrics(rows, f"{store}/{name}")
    stored = t.spark.read.parquet(f"{store}/run_log").select(F.col("run_id").cast("bigint").alias("id"), "started_at")
    expired = retention.expired_runs(stored, "2024-02-01 00:00:00", 15)
    removed = retention.remove_old_runs(
        t.spark, {n: f"{store}/{n}" for n in names[:-1]}, (names[-1], f"{store}/{names[-1]}"), expired
    )
    left = [t.spark.read.parquet(f"{store}/{n}").agg(F.count("*").alias("kept")).select(F.lit(n).alias("table_name"), "kept") for n in names]
    return checks.union_all(left).join(removed.drop("kept"), "table_name")


def _arrived(t: CrmTables, entity: str) -> DataFrame:
    """Raw records in order of arrival, some of them defective; equal ids repeat with other contents."""
    records = defective_records(t, entity)
    return records.select("raw", F.struct("id", F.xxhash64("raw").alias("tie")).alias("seq"))


@query("ordered_load")
def _(t):
    """A full load of all entities from raw records, named in any order; the manifest and what is stored."""
    store = work_dir(t.spark, "store")
    sources = {e.name: _arrived(t, e.name) for e in LOAD_ORDER}
    manifest = load.ordered_load(t.spark, store, sources, sorted(sources), run_id=1)
    held = []
    for e in LOAD_ORDER:
        rows = VersionedTable(t.spark, f"{store}/{e.name}", e.key).current().agg(F.count("*").alias("stored"))
        held.append(rows.select(F.lit(e.name).alias("entity"), "stored"))
    return manifest.join(checks.union_all(held), "entity").select("position", "entity", "status", "rows", "rejected", "stored")


INTERRUPTED = ("users", "tags", "companies", "contacts", "products")


def _interrupted_load(t: CrmTables) -> tuple[DataFrame, run_store.RunStore]:
    """A load that stops as a source is missing, and its second attempt; both manifests and the run's store."""
    store = work_dir(t.spark, "store")
    sources = {n: _arrived(t, n) for n in INTERRUPTED}
    first = load.ordered_load(
        t.spark, store, {n: s for n, s in sources.items() if n != "companies"}, list(INTERRUPTED), run_id=7
    )
    second = load.resume_load(t.spark, store, sources, 7)
    both = first.withColumn("attempt", F.lit(1)).unionByName(second.withColumn("attempt", F.lit(2)))
    return both, run_store.RunStore(t.spark, store)


@query("resumed_load")
def _(t):
    """What either attempt did, beside the stored progress of the entity."""
    tried, log = _interrupted_load(t)
    progress = log.progress().select("entity", F.col("status").alias("progress"), "total_items_processed")
    return tried.join(progress, "entity").select(
        "attempt", "position", "entity", "status", "rows", "rejected", "progress", "total_items_processed"
    )


@query("load_run_metrics")
def _(t):
    """The run analytics on the log of an interrupted and resumed load."""
    _, log = _interrupted_load(t)
    by_run = runs.run_metrics(log.run_log(), log.request_log())
    by_entity = runs.entity_performance(log.request_metrics())
    every = by_run.select(
        "run_id", F.lit("all").alias("entity"), F.col("total_requests").alias("requests"), "total_items", "error_count"
    )
    return every.unionByName(by_entity.select("run_id", "entity", F.col("total_pages").alias("requests"), "total_items", "error_count"))


@query("unread_values")
def _(t):
    """Values of good opportunity records that their type could not hold; some amounts are no numbers."""
    records = raw_records(t, "opportunities")
    no_number = F.regexp_replace("raw", '"projected_revenue_high":[0-9.]+', '"projected_revenue_high":"12 EUR"')
    records = records.withColumn("raw", F.when(F.col("id") % 40 == 7, no_number).otherwise(F.col("raw")))
    return flatten.lost_values(flatten.with_reason(records, ENTITIES["opportunities"], unread=True), ("id",))


@query("incremental_stream")
def _(t):
    """Contacts landed in three drops, one of them replayed, drained and merged twice."""
    landing, store = work_dir(t.spark, "landing"), work_dir(t.spark, "store")
    records = raw_records(t, "contacts")
    job = IncrementalLoad(t.spark, landing, store, ENTITIES["contacts"])
    pages.to_pages(records.filter("id % 3 < 2"), "contacts").write.mode("append").text(landing)
    job.drain()
    job.merge()
    changed = records.filter("id % 3 >= 1").withColumn(
        "raw", F.regexp_replace("raw", '"owner_id":\\d+', '"owner_id":7')
    )
    pages.to_pages(changed, "contacts").write.mode("append").text(landing)
    pages.to_pages(records.filter("id % 3 < 1"), None).write.mode("append").text(landing)
    job.drain()
    return job.merge().select("id", "given_name", "company_id", "owner_id", "updated_at")
