"""Upserts, folds, versioned tables, loads and the stream."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from clientele.operators import files, merge, runs
from clientele.operators.digest import table_digest
from clientele.plans import load
from clientele.plans.run_store import RunStore
from clientele.plans.specs import ENTITIES, LOAD_ORDER
from clientele.session import work_dir
from clientele.sources.versions import VersionedTable
from clientele.streaming.incremental import IncrementalLoad


def table(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_merge_overwrites_with_nulls_and_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id bigint, n string, m string")
    new = spark.createDataFrame(
        [(2, "c", None, 1), (3, "d", "z", 1), (3, "e", None, 2)], "id bigint, n string, m string, seq int"
    )
    once = merge.merge_rows(old, new, ("id",), ("seq",))
    want = [(1, "a", "x"), (2, "c", None), (3, "e", None)]
    assert table(once) == want
    assert table(merge.merge_rows(once, new, ("id",), ("seq",))) == want


@pytest.mark.parametrize("entity", [e.name for e in LOAD_ORDER])
def test_every_entity_merges_on_its_key(spark, entity):
    spec = ENTITIES[entity]
    columns = [*spec.key, "note"]
    schema = ", ".join([f"{k} bigint" for k in spec.key] + ["note string"])
    old = spark.createDataFrame([(*[1] * len(spec.key), "old"), (*[2] * len(spec.key), "old")], schema)
    new = spark.createDataFrame([(*[2] * len(spec.key), None), (*[3] * len(spec.key), "new")], schema)
    got = merge.merge_entity(old, new, spec).select(*columns)
    assert [r.note for r in got.orderBy(spec.key[0]).collect()] == ["old", None, "new"]


def test_one_key_with_a_third_of_all_rows(spark):
    rows = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE 100 + id END AS id", "id AS seq", "id AS value"
    )
    last = merge.latest_per_key(rows, ("id",), ("seq",))
    assert last.count() == 20_001
    assert last.filter("id = 7").first().value == 29_997
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_progress_keeps_first_start_and_last_known_numbers(spark):
    rows = [
        (1, 1, "contacts", "running", 0, None, None), (2, 1, "contacts", "running", 2, 2000, None),
        (3, 1, "contacts", "failed", None, None, "boom"), (4, 1, "contacts", "running", 3, None, None),
        (5, 1, "tasks", "pending", None, None, None), (6, 1, "users", "completed", 1, 10, None),
    ]
    events = spark.createDataFrame(
        rows, "seq bigint, run_id bigint, entity string, status string, page_offset bigint,"
        " items_processed bigint, error_message string"
    ).withColumn("at", F.expr("TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, 0, 0, seq)"))
    got = {r.entity: r for r in merge.merge_progress(events).collect()}
    c = got["contacts"]
    assert (c.status, c.last_page_offset, c.total_items_processed, c.error_message) == ("running", 3, 2000, "boom")
    assert (c.started_at.second, c.completed_at.second, c.updated_at.second) == (1, 3, 4)
    assert got["tasks"].started_at is None and got["tasks"].last_page_offset == 0
    assert got["users"].completed_at.second == 6


def test_run_fold(spark):
    t = dt.datetime(2024, 1, 1)
    events = spark.createDataFrame(
        [(1, 0, "start", t, None, "a"), (1, 1, "end", t, True, "b"), (2, 0, "start", t, None, None),
         (3, 0, "start", t, None, "x"), (3, 1, "end", t, False, None)],
        "run_id bigint, seq int, kind string, at timestamp_ntz, success boolean, notes string",
    )
    got = {r.id: (r.status, r.notes, r.finished_at) for r in merge.fold_run_log(events).collect()}
    assert got == {1: ("success", "a\nb", t), 2: ("running", "", None), 3: ("error", "x", t)}


def test_storing_a_file_twice_leaves_one_row(spark):
    schema = ("id bigint, contact_id bigint, file_hash string, remote_file_id string, file_name string,"
              " file_path string, file_size bigint, mime_type string, created_at timestamp_ntz")  # fmt: skip
    t = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    known = spark.createDataFrame([(1, 9, "h", "r1", "old", "/o", 1, "a", t[0])], schema)
    batch = spark.createDataFrame(
        [(2, 9, "h", "r2", "new", "/n", 2, None, t[1], 1, t[1]), (3, 9, "g", "r3", "g1", "/g", 3, "b", t[1], 2, t[1]),
         (4, 9, "g", "r4", "g2", "/g2", 4, "c", t[2], 3, t[2])],
        schema + ", seq bigint, at timestamp_ntz",
    )
    got = {r.file_hash: r for r in files.merge_files(known, batch).collect()}
    h, g = got["h"], got["g"]
    assert (h.id, h.remote_file_id, h.created_at, h.file_name, h.mime_type, h.updated_at) == (1, "r1", t[0], "new", None, t[1])
    assert (g.id, g.remote_file_id, g.created_at, g.file_name, g.updated_at) == (3, "r3", t[1], "g2", t[2])


def test_file_sync_totals(spark):
    incoming = spark.createDataFrame(
        [(1, "a", "/a"), (1, "a", "/a2"), (1, "b", None), (1, "k", "/k"), (2, "a", "/a")],
        "contact_id bigint, file_hash string, file_path string",
    )
    known = spark.createDataFrame([(1, "k")], "contact_id bigint, file_hash string")
    got = {r.contact_id: tuple(r)[1:] for r in files.file_sync_totals(incoming, known).collect()}
    assert got == {1: (4, 1, 3), 2: (1, 1, 0), None: (5, 2, 3)}
    assert files.new_files_only(incoming, known).count() == 4


def test_retention_and_metrics(spark):
    runs = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 20))], "id bigint, started_at timestamp_ntz"
    )
    child = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "run_id bigint, x string")
    kept = merge.retain_runs(runs, "2024-01-31 00:00:00", 15)
    assert [r.id for r in kept.collect()] == [2]
    assert merge.retain_children(child, kept).count() == 2
    store = work_dir(spark, "metrics")
    load.append_metrics(child, store)
    load.append_metrics(child, store)
    assert spark.read.parquet(store).filter("run_id = 2").count() == 4


# --- versioned tables ------------------------------------------------------------------


def test_merge_rewrites_only_touched_ranges(spark):
    path = work_dir(spark, "versions")
    t = VersionedTable(spark, path, part_width=100)
    assert t.current() is None and t.version == 0
    t.replace(spark.range(1000).selectExpr("id", "'a' AS v"), tag=5)
    t.merge(spark.sql("SELECT id, 'b' AS v FROM VALUES (5L), (7L), (1001L) AS t(id)"), tag=6)
    again = VersionedTable(spark, path, part_width=100)
    assert (again.version, again.last_tag()) == (2, 6)
    now = again.current()
    assert now.columns == ["id", "v"] and now.count() == 1001
    assert sorted(r.id for r in now.filter("v = 'b'").collect()) == [5, 7, 1001]
    folders = {e.folder: e.parts for e in again._live}
    assert sorted(map(len, folders.values())) == [2, 9]


def test_folders_are_folded_together_and_empty_tables_work(spark):
    t = VersionedTable(spark, work_dir(spark, "versions"), part_width=10, max_folders=3)
    t.replace(spark.range(0).selectExpr("id", "'a' AS v"))
    assert t.current().columns == ["id", "v"] and t.current().count() == 0
    for i in range(5):
        t.merge(spark.range(i * 10, i * 10 + 2).selectExpr("id", f"'{i}' AS v"))
    assert t.current().count() == 10 and len(t._live) <= 3


def test_a_merge_brings_new_columns(spark):
    path = work_dir(spark, "versions")
    t = VersionedTable(spark, path, part_width=10)
    t.replace(spark.sql("SELECT id, 'a' AS v, 1 AS n FROM range(30)"))
    t.merge(spark.sql("SELECT id, 'b' AS v, id * 10 AS extra, 5 AS seq FROM VALUES (3L), (31L) AS t(id)"), ("seq",))
    t.merge(spark.sql("SELECT 4L AS id, 'c' AS v, 2L AS n, 7L AS extra"))
    t.merge(spark.sql("SELECT 0L AS id, 'x' AS v, 'later' AS note").filter("id = 1"))
    now = VersionedTable(spark, path, part_width=10).current()
    assert now.columns == ["id", "v", "n", "extra", "note"]
    got = {r.id: tuple(r)[1:] for r in now.collect()}
    assert len(got) == 31
    assert (got[3], got[31]) == (("b", None, 30, None), ("b", None, 310, None))
    assert (got[4], got[5], got[25]) == (("c", 2, 7, None), ("a", 1, None, None), ("a", 1, None, None))
    # A value that does not fit the stored type ends the merge and leaves the version.
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        t.merge(spark.sql("SELECT 4L AS id, 'd' AS v, 'many' AS n"))
    assert VersionedTable(spark, path, part_width=10).version == 4


def test_joining_folders_leaves_the_large_one(spark):
    t = VersionedTable(spark, work_dir(spark, "versions"), part_width=10, max_folders=4)
    t.replace(spark.range(1000).selectExpr("id", "'a' AS v"))
    first = t._live[0].folder
    for i in range(12):
        t.merge(spark.range(i * 10, i * 10 + 2).selectExpr("id", f"'{i}' AS v"), tag=i)
    assert len(t._live) <= 4 and first in {e.folder for e in t._live} and t.last_tag() == 11
    parts = [p for e in t._live for p in e.parts]
    assert sorted(parts) == list(range(100))
    assert t.current().count() == 1000 and t.current().filter("v != 'a'").count() == 24


def test_stored_digest_follows_every_change(spark):
    def check():
        again = VersionedTable(spark, path, key, part_width=10)
        assert again.digest("t").first() == table_digest(again.current(), key, "t").first()

    for key, pair in ((("id",), "id, id AS b"), (("a", "b"), "id AS a, id % 3 AS b")):
        path = work_dir(spark, "versions")
        t = VersionedTable(spark, path, key, part_width=10, max_folders=3)
        assert t.digest("t").first().row_count == 0
        t.replace(spark.range(0).selectExpr(*pair.split(", ")))
        check()
        t.merge(spark.range(100).selectExpr(*pair.split(", ")))
        check()
        for i in range(3):  # some keys replaced, some new; folders are joined on the way
            t.merge(spark.range(i * 30, i * 30 + 15).selectExpr(*pair.split(", ")))
            check()
        t.remove([0, 5, 99])
        check()
        # Ranges that were not written again are not read again.
        before = spark.read.parquet(f"{path}/digests").count()
        t = VersionedTable(spark, path, key, part_width=10)
        t.merge(spark.range(1).selectExpr(*pair.split(", ")))
        check()
        assert spark.read.parquet(f"{path}/digests").count() == before + 1


def test_snapshots_are_kept_per_run(spark):
    store = work_dir(spark, "store")
    log = RunStore(spark, store)
    assert log.snapshots().count() == 0
    t = VersionedTable(spark, f"{store}/tags", part_width=10)
    t.replace(spark.range(25).toDF("id"))
    log.take_snapshot(1, {"tags": t})
    t.merge(spark.range(20, 40).toDF("id"))
    log.take_snapshot(2, {"tags": t})
    log.take_snapshot(2, {"tags": t})
    kept = log.snapshots()
    assert [(r.run_id, r.row_count, r.id_max) for r in kept.orderBy("run_id").collect()] == [(1, 25, 24), (2, 40, 39)]
    delta = runs.snapshot_delta(kept).first()
    assert (delta.current_rows, delta.previous_rows, delta.delta) == (40, 25, 15)


# --- loads -----------------------------------------------------------------------------


def raw(spark, *records):
    texts = [(r if isinstance(r, str) else json.dumps(r), i) for i, r in enumerate(records)]
    return spark.createDataFrame(texts, "raw string, seq int")


def test_ordered_load(spark):
    store = work_dir(spark, "store")
    sources = {
        "contacts": raw(spark, {"id": 1, "given_name": "A"}, {"id": 1, "given_name": "B"}, '{"id": 2'),
        "users": raw(spark, {"id": 1, "given_name": "U"}),
    }
    dry = load.ordered_load(spark, store, sources, ["contacts", "users"], dry_run=True).collect()
    assert [(r.entity, r.status, r.rows) for r in dry] == [("users", "dry run", 1), ("contacts", "dry run", 3)]
    assert VersionedTable(spark, f"{store}/users").version == 0

    for _ in range(2):  # the same input twice gives the same table
        done = load.ordered_load(spark, store, sources, ["contacts", "users"], run_id=4).collect()
        assert [(r.entity, r.rows, r.rejected) for r in done] == [("users", 1, 0), ("contacts", 2, 1)]
        rows = VersionedTable(spark, f"{store}/contacts").current().collect()
        assert [(r.id, r.given_name) for r in rows] == [(1, "B")]
    counts = VersionedTable(spark, f"{store}/meta/source_counts", ("run_id", "entity")).current()
    assert sorted((r.run_id, r.entity, r.items_retrieved) for r in counts.collect()) == [(4, "contacts", 3), (4, "users", 1)]
    events = spark.read.parquet(f"{store}/meta/run_events")
    assert events.filter("kind = 'end' AND success").count() == 2


def test_load_stops_or_goes_on_after_a_failure(spark):
    broken = spark.createDataFrame([(1,)], "wrong int")
    sources = {"users": broken, "tags": raw(spark, {"id": 1, "name": "t"})}
    stopped = load.ordered_load(spark, work_dir(spark, "s"), sources, ["tags", "users"]).collect()
    assert [(r.entity, r.status) for r in stopped] == [("users", "failed")]
    store = work_dir(spark, "s")
    on = load.ordered_load(spark, store, sources, ["tags", "users"], continue_on_error=True, run_id=1)
    assert [(r.entity, r.status) for r in on.collect()] == [("users", "failed"), ("tags", "loaded")]
    assert spark.read.parquet(f"{store}/meta/error_events").count() == 1
    with pytest.raises(ValueError, match="unknown entities: nothing"):
        load.ordered_load(spark, store, sources, ["nothing"])


def test_load_since(spark):
    store = work_dir(spark, "s")
    sources = {"users": raw(spark, {"id": 1, "last_updated": "2024-01-01"}, {"id": 2, "last_updated": "2024-03-01"})}
    load.ordered_load(spark, store, sources, ["users"], since="2024-02-01T00:00:00Z")
    assert [r.id for r in VersionedTable(spark, f"{store}/users").current().collect()] == [2]


def test_load_since_without_updated_at(spark):
    store = work_dir(spark, "s")
    links = [{"contact_id": 1, "tag_id": t, "date_created": f"2024-0{t}-01T00:00:00Z"} for t in (1, 3)]
    load.ordered_load(spark, store, {"contact_tags": raw(spark, *links)}, ["contact_tags"], since="2024-02-01T00:00:00Z")
    table = VersionedTable(spark, f"{store}/contact_tags", ENTITIES["contact_tags"].key)
    assert [r.tag_id for r in table.current().collect()] == [3]


# --- stream ----------------------------------------------------------------------------


def land(spark, folder, *records):
    text = json.dumps({"contacts": list(records)})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(folder)


def contact(i, name, updated):
    return {"id": i, "given_name": name, "last_updated": updated}


def test_stream_applies_updates_and_ignores_replays(spark):
    landing, store = work_dir(spark, "landing"), work_dir(spark, "store")
    job = IncrementalLoad(spark, landing, store, ENTITIES["contacts"])
    first = [contact(1, "a", "2024-01-01"), contact(2, "b", "2024-01-01"), contact(2, "b2", "2024-01-02")]
    land(spark, landing, *first)
    job.drain()

    def names():
        return {r.id: r.given_name for r in job.merge().collect()}

    assert names() == {1: "a", 2: "b2"}
    version = job.table.version
    job.drain()
    assert names() == {1: "a", 2: "b2"} and job.table.version == version  # nothing new
    land(spark, landing, contact(1, "a2", "2024-01-05"), contact(3, "c", None))
    job.drain()
    assert names() == {1: "a2", 2: "b2", 3: "c"}
    land(spark, landing, *first)  # an old page again
    land(spark, landing, contact(1, "a2", "2024-01-05"))
    job.drain()
    assert names() == {1: "a2", 2: "b2", 3: "c"}
    land(spark, landing, {"given_name": "no id"})
    job.drain()
    assert names() == {1: "a2", 2: "b2", 3: "c"}
    assert [(r.reason, r.pos) for r in job.rejected().collect()] == [("no key", 0)]
    # A new process goes on where this one stopped.
    again = IncrementalLoad(spark, landing, store, ENTITIES["contacts"])
    again.drain()
    assert {r.id: r.given_name for r in again.merge().collect()} == {1: "a2", 2: "b2", 3: "c"}


def test_the_last_page_of_a_file_wins(spark):
    """Without ``updated_at``, a later line beats a greater place in an earlier line."""
    landing, store = work_dir(spark, "landing"), work_dir(spark, "store")
    pages = ['{"tags":[{"id":9,"name":"x"},{"id":1,"name":"old"}]}', "", '[{"id":1,"name":"new"}]']
    spark.createDataFrame([(p,) for p in pages], "value string").coalesce(1).write.text(landing)
    job = IncrementalLoad(spark, landing, store, ENTITIES["tags"])
    job.drain()
    assert {r.id: r.name for r in job.merge().collect()} == {1: "new", 9: "x"}
