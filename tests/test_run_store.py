"""Stored run metadata: states that combine, loads that die and go on, values that types lose, whole exports."""

import datetime as dt
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from clientele.operators import flatten, merge, runs
from clientele.plans import load, retention
from clientele.plans.catalog import QUERIES
from clientele.plans.run_store import RunStore, fold_into
from clientele.plans.specs import ENTITIES
from clientele.session import work_dir
from clientele.sources import exports
from clientele.sources.bindings import STAR
from clientele.sources.versions import VersionedTable, path_exists
from tests.test_merge import raw

EVENTS = "seq bigint, run_id bigint, entity string, status string, page_offset bigint, items_processed bigint, error_message string, at timestamp_ntz"


def events(spark, n=40):
    dice = random.Random(2)
    rows = []
    for seq in range(n):
        status = dice.choice(["pending", "running", "completed", "failed"])
        numbers = (dice.choice([None, seq]), dice.choice([None, 7 * seq]), dice.choice([None, f"e{seq}"]))
        rows.append((seq, seq % 3, "ab"[seq % 2], status, *numbers, dt.datetime(2024, 1, 1, 0, seq)))
    return spark.createDataFrame(rows, EVENTS)


@pytest.mark.parametrize("cuts", [((0, 40),), ((20, 40), (0, 20)), ((5, 9), (0, 40), (5, 30)), ((39, 40), (0, 1), (1, 39))])
def test_any_split_of_the_events_leaves_the_same_progress(spark, cuts):
    every = events(spark)
    table = VersionedTable(spark, work_dir(spark, "progress"), merge.PROGRESS_KEY, part_width=1)
    for low, high in cuts:
        fold_into(table, merge.progress_states(every.filter(f"seq >= {low} AND seq < {high}")), merge.combine_progress)
    want = sorted(tuple(r) for r in merge.merge_progress(every).collect())
    assert sorted(tuple(r) for r in merge.progress_rows(table.current()).collect()) == want and len(want) == 6


def test_progress_of_one_entity(spark):
    rows = [
        (1, 1, "a", "running", 5, None, None), (2, 1, "a", "failed", None, 10, "x"), (3, 1, "a", "running", None, None, None),
        (4, 1, "a", "completed", 9, None, None), (0, 1, "a", "pending", None, None, None), (9, 2, "a", "pending", None, None, None),
    ]
    at = [dt.datetime(2024, 1, 1, r[0]) for r in rows]
    got = merge.merge_progress(spark.createDataFrame([(*r, t) for r, t in zip(rows, at)], EVENTS)).orderBy("run_id").collect()
    hour = lambda t: None if t is None else t.hour
    assert [(r.status, hour(r.started_at), hour(r.completed_at), r.last_page_offset, r.total_items_processed, r.error_message, hour(r.created_at)) for r in got] == [
        ("completed", 1, 4, 9, 10, "x", 0), ("pending", None, None, 0, 0, None, 9),
    ]


def test_newest_checkpoint_stays_whatever_the_order(spark):
    rows = [(1, "a", "page", f"d{s}", dt.datetime(2024, 1, 1, h), s) for s, h in ((1, 3), (2, 5), (3, 5), (4, 1))]
    schema = "run_id bigint, entity string, checkpoint_type string, checkpoint_data string, created_at timestamp_ntz, seq bigint"
    for order in itertools.islice(itertools.permutations(rows), 0, 24, 5):
        table = VersionedTable(spark, work_dir(spark, "checkpoints"), merge.CHECKPOINT_KEY, part_width=1)
        for row in order:
            one = spark.createDataFrame([row], schema)
            fold_into(table, merge.newest_checkpoints(one), merge.newest_checkpoints)
        assert [r.checkpoint_data for r in table.current().collect()] == ["d3"]


# --- resume ----------------------------------------------------------------------------

NAMES = ["users", "tags", "companies", "contacts"]


def sources(spark):
    return {n: raw(spark, {"id": 1, "given_name": "G", "name": "N"}, {"id": 2}, '{"id": 3') for n in NAMES}


class Died(BaseException):
    """Stands for a driver that is gone: nothing after it runs."""


def loaded_names(monkeypatch):
    """The entities whose loading is begun from now on."""
    seen, plain = [], load.load_entity

    def watched(spark, store, entity, *rest):
        seen.append(entity.name)
        return plain(spark, store, entity, *rest)

    monkeypatch.setattr(load, "load_entity", watched)
    return seen


def test_a_failed_load_resumes_with_the_rest(spark, monkeypatch):
    store = work_dir(spark, "store")
    broken = {n: s for n, s in sources(spark).items() if n != "companies"}
    first = load.ordered_load(spark, store, broken, NAMES, run_id=5).collect()
    assert [(r.entity, r.status) for r in first] == [("users", "loaded"), ("tags", "loaded"), ("companies", "failed")]
    log = RunStore(spark, store)
    assert log.interrupted_run() is None  # it ended, with an error
    assert log.left_to_do(5) == ["companies", "contacts"]
    seen = loaded_names(monkeypatch)
    second = load.resume_load(spark, store, sources(spark), 5).collect()
    assert seen == ["companies", "contacts"]
    assert [(r.entity, r.status, r.rows, r.rejected) for r in second] == [("companies", "loaded", 2, 1), ("contacts", "loaded", 2, 1)]
    assert {(r.entity, r.status, r.total_items_processed) for r in log.progress().collect()} == {(n, "completed", 2) for n in NAMES}
    assert [(r.id, r.status) for r in log.run_log().collect()] == [(5, "success")]
    assert sorted((r.entity, json.loads(r.checkpoint_data)["rows"]) for r in log.checkpoints().collect()) == sorted((n, 2) for n in NAMES)
    assert load.resume_load(spark, store, sources(spark), 5).collect() == []
    # The analytics of runs read what the load has written.
    (total,) = runs.run_metrics(log.run_log(), log.request_log()).collect()
    assert (total.total_requests, total.total_items, total.error_count, total.throttle_count) == (5, 12, 1, 0)
    pages = {r.entity: (r.total_pages, r.total_items, r.retry_attempts, r.error_count) for r in runs.entity_performance(log.request_metrics()).collect()}
    assert pages == {"users": (1, 3, 0, 0), "tags": (1, 3, 0, 0), "companies": (2, 3, 1, 1), "contacts": (1, 3, 0, 0)}
    assert runs.error_analysis(spark.read.parquet(f"{store}/meta/error_events")).count() == 1


@pytest.mark.parametrize("moment", ["staged", "committed"])
def test_a_load_that_dies_goes_on_where_it_was(spark, monkeypatch, moment):
    store, plain = work_dir(spark, "store"), load.load_entity

    def dying(spark, store, entity, *rest):
        if entity.name == "companies" and moment == "staged":
            monkeypatch.setattr(VersionedTable, "replace", lambda *a, **k: (_ for _ in ()).throw(Died()))
        done = plain(spark, store, entity, *rest)
        if entity.name == "companies":
            raise Died
        return done

    with monkeypatch.context() as patch:
        patch.setattr(load, "load_entity", dying)
        patch.setattr(VersionedTable, "replace", VersionedTable.replace)
        with pytest.raises(Died):
            load.ordered_load(spark, store, sources(spark), NAMES, run_id=8)
    monkeypatch.undo()
    table = VersionedTable(spark, f"{store}/companies")
    assert table.last_tag() == (8 if moment == "committed" else None)
    # The records of the entity are not read again: they have been staged.
    gone = sources(spark) | {"companies": sources(spark)["companies"].filter("raise_error('read again') IS NULL")}
    seen = loaded_names(monkeypatch)
    second = load.resume_load(spark, store, gone).collect()
    assert seen == ["companies", "contacts"]
    assert [(r.entity, r.status, r.rows, r.rejected) for r in second] == [("companies", "loaded", 2, 1), ("contacts", "loaded", 2, 1)]
    table = VersionedTable(spark, f"{store}/companies")
    assert (table.version, table.last_tag(), table.current().count()) == (1, 8, 2)
    log = RunStore(spark, store)
    assert {(r.entity, r.status) for r in log.progress().collect()} == {(n, "completed") for n in NAMES}
    assert [r.status for r in log.run_log().collect()] == ["success"]


def test_nothing_to_resume(spark):
    assert load.resume_load(spark, work_dir(spark, "store"), {}).collect() == []
    log = RunStore(spark, work_dir(spark, "store"))
    assert (log.progress().count(), log.checkpoints().count(), log.run_log().count()) == (0, 0, 0)


def test_old_runs_are_removed_with_all_their_rows(spark, monkeypatch):
    store = work_dir(spark, "store")
    log = RunStore(spark, store)
    for run, day in ((1, 1), (2, 20), (3, 25)):
        monkeypatch.setattr("clientele.plans.run_store.now", lambda day=day: dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc))
        monkeypatch.setattr(load, "now", lambda day=day: dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc))
        load.ordered_load(spark, store, sources(spark), ["users", "tags"], run_id=run)
    log._append("run_events", [(4, 0, "end", None, True, "no start")], "run_id bigint, seq bigint, kind string, at timestamp, success boolean, notes string")
    removed = {r.table_name: (r.kept, r.removed) for r in log.retain("2024-01-31 00:00:00", 15).collect()}
    assert removed == {"progress_events": (12, 6), "request_metrics": (4, 2), "error_events": (0, 0), "run_events": (5, 2)}
    assert sorted(r.id for r in log.run_log().collect()) == [2, 3, 4]
    for table in (log.progress(), log.checkpoints(), log.source_counts(), log.request_metrics()):
        assert {r.run_id for r in table.select("run_id").collect()} == {2, 3}
    again = {r.removed for r in log.retain("2024-01-31 00:00:00", 15).collect()}
    assert again == {0} and load.resume_load(spark, store, {}, 2).collect() == []


def test_a_removal_that_died_is_taken_up_again(spark, monkeypatch):
    store = work_dir(spark, "runs")
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "run_id bigint, v string")
    runs_of = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 30))], "run_id bigint, started_at timestamp_ntz")
    for name in ("x", "y"):
        load.append_metrics(rows, f"{store}/{name}")
    load.append_metrics(runs_of, f"{store}/log")
    paths, plain = {n: f"{store}/{n}" for n in ("x", "y")}, retention.drop_path

    def dying(spark, path):
        if "/y/" in path:
            raise Died
        return plain(spark, path)

    def log():
        return spark.read.parquet(f"{store}/log").selectExpr("CAST(run_id AS BIGINT) AS id", "started_at")

    expired = retention.expired_runs(log(), "2024-02-01 00:00:00", 15)
    with monkeypatch.context() as patch:
        patch.setattr(retention, "drop_path", dying)
        with pytest.raises(Died):
            retention.remove_old_runs(spark, paths, ("log", f"{store}/log"), expired)
    assert [spark.read.parquet(p).count() for p in paths.values()] == [1, 3]
    assert retention.expired_runs(log(), "2024-02-01 00:00:00", 15) == [1]
    done = retention.remove_old_runs(spark, paths, ("log", f"{store}/log"), [1]).collect()
    assert [tuple(r) for r in done] == [("x", 1, 0), ("y", 1, 2), ("log", 1, 1)]


# --- disk --------------------------------------------------------------------------------


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in files.mkString("\n").split("\n") if "/shuffle_" in name}


def staged_ids(spark, folder):
    return sorted(r.id for r in spark.read.parquet(folder).collect())


def test_a_load_in_slices_keeps_the_last_row_of_each_key(spark, monkeypatch):
    store, plain, written = work_dir(spark, "store"), VersionedTable.replace, []

    def watched(table, *frames, tag=None):
        written.append([f.count() for f in frames])
        return plain(table, *frames, tag=tag)

    monkeypatch.setattr(load, "AT_ONCE", 1)
    monkeypatch.setattr(VersionedTable, "replace", watched)
    records = raw(spark, *[{"id": i % 40, "name": f"n{i}"} for i in range(100)], '{"id": 7', {"name": "no id"})
    before = shuffle_files(spark)
    done = load.ordered_load(spark, store, {"tags": records}, ["tags"]).collect()
    assert [(r.status, r.rows, r.rejected) for r in done] == [("loaded", 100, 2)]
    assert not shuffle_files(spark) - before
    ((*slices,),) = written
    assert len(slices) == load.SLICES and sum(slices) == 40 and max(slices) < 20
    table = VersionedTable(spark, f"{store}/tags")
    rows = {r.id: r.name for r in table.current().collect()}
    assert rows == {i: f"n{i + 80 if i < 20 else i + 40}" for i in range(40)} and table.current().count() == 40
    assert len(table._live) == 1 and table.version == 1


def test_staged_rows_go_once_their_table_is_logged(spark):
    store = work_dir(spark, "store")
    tables = {"products": raw(spark, {"id": 1, "price": "free"}, {"id": 2, "price": 3}, {"id": 3}), "tags": raw(spark, {"id": 1})}
    load.ordered_load(spark, store, tables, ["tags", "products"], run_id=1)
    assert staged_ids(spark, f"{store}/staged/products/run-1") == [1]
    assert staged_ids(spark, f"{store}/staged/tags/run-1") == []
    assert "reason" in spark.read.parquet(f"{store}/staged/tags/run-1").columns
    assert not path_exists(spark, f"{store}/staged/products/run-1/_SUCCESS")
    assert VersionedTable(spark, f"{store}/products").current().count() == 3


def test_a_cleared_stage_is_not_taken_for_a_whole_one(spark):
    store, products = work_dir(spark, "store"), raw(spark, {"id": 1, "name": "a", "price": "free"}, {"id": 2, "name": "b"})
    load.ordered_load(spark, store, {"products": products}, ["products"], run_id=1)
    load.ordered_load(spark, store, {"products": raw(spark, {"id": 2, "name": "x"})}, ["products"], run_id=2)
    log = RunStore(spark, store)
    log.log_progress([load._update(1, log.next_seq(1), "products", "pending")])
    again = load.resume_load(spark, store, {"products": products}, 1).collect()
    assert [(r.status, r.rows, r.rejected) for r in again] == [("loaded", 2, 0)]
    assert {r.id: r.name for r in VersionedTable(spark, f"{store}/products").current().collect()} == {1: "a", 2: "b"}


# --- snapshots of loads ------------------------------------------------------------------


def star_tables(spark):
    """Four rows of every star table that the snapshot queries read."""
    folder, day = work_dir(spark, "star"), dt.datetime(2024, 1, 1)
    rows = {
        "supplier": lambda i: (i, f"S{i}", 1, 1.5),
        "customer": lambda i: (i, f"C{i}", 1, 1.5, "M"),
        "orders": lambda i: (i, i, "O", 1.5, day, "1-LOW"),
        "part": lambda i: (i, f"P{i}", "B", "T", 1, 1.5),
    }
    for name, row in rows.items():
        spark.createDataFrame([row(i) for i in range(4)], STAR[name]).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name, attempt", [("stored_snapshot_delta", 2), ("stored_snapshots", 1)])
def test_a_failed_load_ends_the_snapshot_queries(spark, monkeypatch, name, attempt):
    folder, plain, tries = star_tables(spark), load.load_entity, []

    def failing(spark, store, entity, *rest):
        tries.append(entity.name)
        if tries.count("users") == attempt:
            raise OSError("No space left on device")
        return plain(spark, store, entity, *rest)

    monkeypatch.setattr(load, "load_entity", failing)
    with pytest.raises(load.LoadFailed, match="users: OSError: No space left on device"):
        QUERIES[name](spark, folder).collect()


# --- values that do not fit --------------------------------------------------------------


def test_lost_values_are_reported_beside_the_row(spark):
    rows = raw(
        spark,
        {"id": 1, "value": "12 EUR", "date_created": "soon", "contact": {"id": "x"}, "owner_id": "3.5e"},
        {"id": 2, "value": "12.50", "date_created": "2024-01-01", "contact": {"id": 4}, "currency": "any"},
        {"id": 3, "value": "", "date_created": None, "last_updated": "  "},
        {"id": "no id", "value": "x"},
        '{"id": 5, "value": "y"',
    )
    marked = flatten.with_reason(rows, ENTITIES["opportunities"], unread=True)
    lost = sorted(tuple(r) for r in flatten.lost_values(marked, ("id",)).collect())
    assert lost == [(1, "contact_id", "x"), (1, "created_at", "soon"), (1, "owner_id", "3.5e"), (1, "value", "12 EUR")]
    good = flatten.good_rows(marked)
    assert sorted(r.id for r in good.collect()) == [1, 2, 3] and "unread" not in good.columns
    assert good.columns == flatten.good_rows(flatten.with_reason(rows, ENTITIES["opportunities"])).columns
    keyless = marked.filter("reason = 'no key'").select(F.to_json("unread")).collect()
    assert json.loads(keyless[0][0]) == [{"field": "id", "text": "no id"}, {"field": "value", "text": "x"}]


def test_a_load_keeps_lost_values_in_its_stage(spark):
    store = work_dir(spark, "store")
    load.ordered_load(spark, store, {"products": raw(spark, {"id": 1, "price": "free"}, {"id": 2, "price": 3})}, ["products"], run_id=1)
    staged = spark.read.parquet(f"{store}/staged/products/run-1")
    assert [tuple(r) for r in flatten.lost_values(staged, ("id",)).collect()] == [(1, "price", "free")]
    assert "unread" not in VersionedTable(spark, f"{store}/products").current().columns


# --- exports -----------------------------------------------------------------------------


def test_any_further_sub_key_survives_a_round_trip(spark):
    emails = [
        '[{"email":"a@x","field":"EMAIL1","opt_in":{"reason":"web","at":[1,2]}}]', '[{"email":"b@x","score":1.5}]', "[]", None,
        '[{"email":"c@x","score":"high","a b":true}]', "no json",
    ]
    table = spark.createDataFrame([(i, e, '[3,4]', '{"k":"v"}') for i, e in enumerate(emails)], "id bigint, email_addresses string, tag_ids string, custom_fields string")
    folder = work_dir(spark, "parquet")
    assert exports.export_parquet(table, folder) == 6
    back = {r.id: r for r in spark.read.parquet(folder).collect()}
    first = back[0].email_addresses[0]
    assert (first.email, first.field, first.opt_in.reason, first.opt_in["at"]) == ("a@x", "EMAIL1", "web", [1, 2])
    assert (back[1].email_addresses[0].score, back[4].email_addresses[0].score, back[4].email_addresses[0]["a b"]) == ("1.5", "high", True)
    assert back[2].email_addresses == [] and back[3].email_addresses is None and back[5].email_addresses is None
    assert back[0].tag_ids == [3, 4] and back[0].custom_fields == {"k": "v"}


def test_declared_shapes_stand_where_there_are_no_values(spark):
    table = spark.createDataFrame([(1, None)], "id bigint, email_addresses string")
    folder = work_dir(spark, "parquet")
    assert exports.export_parquet(table, folder) == 1
    assert spark.read.parquet(folder).schema["email_addresses"].dataType.simpleString() == "array<struct<email:string,field:string>>"


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_an_empty_export_leaves_no_file_and_computes_once(spark, fmt):
    folder = work_dir(spark, fmt)
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        seen.add(1)
        yield from batches

    table = spark.range(4).selectExpr("id", "'a' AS v").coalesce(1).mapInPandas(watched, "id bigint, v string")
    assert exports._write(table, folder, fmt) == 4 and seen.value == 1
    empty = work_dir(spark, fmt)
    assert exports._write(table.limit(0), empty, fmt) == 0 and not path_exists(spark, empty)
