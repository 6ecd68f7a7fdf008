"""Runs, contacts, files, digests, ranks, comparison and exports."""

import datetime as dt
import glob
import hashlib

import pytest
from pyspark.sql import functions as F

from clientele.operators import compare, contacts, digest, files, runs
from clientele.plans.specs import ENTITIES
from clientele.session import work_dir
from clientele.sources import exports, tables


def test_five_requests(spark):
    log = spark.createDataFrame(
        [(1, 20, 500, False, None)] * 5, "run_id bigint, item_count bigint, duration_ms bigint, throttled boolean, error string"
    )
    got = runs.run_metrics(spark.createDataFrame([(1,), (2,)], "id bigint"), log).orderBy("run_id").collect()
    assert tuple(got[0]) == (1, 5, 100, 2500, 0, 0) and tuple(got[1]) == (2, 0, 0, 0, 0, 0)


def test_throughput_without_time_is_zero(spark):
    metrics = spark.createDataFrame(
        [(1, "a", 10, 0, 50, 1, None), (1, "b", 10, None, None, 0, "e"), (1, "c", 10, 500, 200, 0, None)],
        "run_id bigint, entity string, item_count bigint, duration_ms bigint, throttle_remaining bigint,"
        " retry_count bigint, error_message string",
    )
    got = {r.entity: r for r in runs.entity_performance(metrics).collect()}
    assert [got[e].throughput_items_per_second for e in "abc"] == [0.0, 0.0, 20.0]
    assert [got[e].throttle_hits for e in "abc"] == [1, 0, 0] and got["b"].error_count == 1


def test_resume(spark):
    t = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame(
        [(1, "running", t), (2, "running", t + dt.timedelta(1)), (3, "success", t), (4, "running", t + dt.timedelta(2))],
        "id bigint, status string, started_at timestamp_ntz",
    )
    progress = spark.createDataFrame(
        [(1, "a", "pending", 0, 1000, t), (2, "b", "failed", 3, 1000, t + dt.timedelta(1)),
         (2, "a", "running", 5, 1000, t), (3, "a", "completed", 1, 1000, t), (4, "a", "completed", 1, 1000, t)],
        "run_id bigint, entity string, status string, last_page_offset int, last_page_limit int, created_at timestamp_ntz",
    )
    assert [r.id for r in runs.interrupted_runs(log, progress).collect()] == [2]
    assert [r.id for r in runs.interrupted_runs(log, progress, current_run=2).collect()] == [1]
    todo = runs.entities_to_resume(progress.filter("run_id = 2")).collect()
    assert [(r.entity_name, r.last_page_offset) for r in todo] == [("a", 5), ("b", 3)]
    last = {r.entity: r.last_run_id for r in runs.last_successful_run(log, progress).collect()}
    assert last == {"a": 3, "b": 0}


def test_missing_checkpoint_is_an_empty_object(spark):
    saved = spark.createDataFrame(
        [(1, "a", "page", "{1}", 1, 1), (1, "a", "page", "{2}", 2, 2)],
        "run_id bigint, entity string, checkpoint_type string, checkpoint_data string, created_at int, seq int",
    )
    assert runs.checkpoint_of(saved, 1, "a", "page").first()[0] == "{2}"
    assert runs.checkpoint_of(saved, 1, "b", "page").first()[0] == "{}"


def test_single_run_filters(spark):
    log = spark.createDataFrame([(1, 1), (2, 5)], "id bigint, started_at int")
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "run_id bigint, v string")
    assert [r.v for r in runs.for_run(rows, None, log).collect()] == ["y"]
    assert [r.v for r in runs.for_run(rows, 1).collect()] == ["x"]


def test_snapshot_of_a_first_run_has_no_previous(spark):
    snaps = spark.createDataFrame([("t", 1, 5, "crm"), ("t", 3, 9, "crm"), ("u", 3, 4, "crm"), ("t", 4, 1, "x")],
                                  "table_name string, run_id bigint, row_count bigint, schema_name string")
    got = [tuple(r) for r in runs.snapshot_delta(snaps).collect()]
    assert got == [("t", 9, 5, 4), ("u", 4, None, 4)]


def test_snapshots_are_ranked_newest_first(spark):
    snaps = spark.createDataFrame([("t", r, 5) for r in (1, 12, 3)] + [("u", 2, 1)], "table_name string, run_id bigint, row_count bigint")
    got = {(r.table_name, r.run_id): r.rn for r in runs.rank_snapshots(snaps).collect()}
    assert got == {("t", 12): 1, ("t", 3): 2, ("t", 1): 3, ("u", 2): 1}


def test_contact_counts_against_the_literal_join(spark, shop):
    for n in shop:
        shop[n].createOrReplaceTempView(f"t_{n}")
    want = spark.sql("""
        SELECT c.id, count(DISTINCT o.id), count(DISTINCT t.id), count(DISTINCT n.id),
               count(DISTINCT ct.tag_id), sum(o.value)
        FROM t_contacts c LEFT JOIN t_opportunities o ON c.id = o.contact_id
        LEFT JOIN t_tasks t ON c.id = t.contact_id LEFT JOIN t_notes n ON c.id = n.contact_id
        LEFT JOIN t_contact_tags ct ON c.id = ct.contact_id GROUP BY c.id""")
    text = ["phone", "address", "city", "state", "postal_code", "country_code", "email_status", "email_opted_in",
            "score_value", "created_at", "updated_at"]
    wide = {
        **shop,
        "contacts": shop["contacts"].withColumns({c: F.lit(None).cast("string") for c in text}),
        "companies": shop["companies"].withColumn("website", F.lit(None).cast("string")),
        "users": shop["users"].withColumn("email", F.lit("u")),
    }
    got = contacts.contact_analytics(wide, fanout=True).selectExpr(
        "contact_id", "opportunity_count", "task_count", "note_count", "tag_count",
        "CAST(total_opportunity_value AS DOUBLE)",
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    true_sum = {r.contact_id: r.total_opportunity_value for r in contacts.contact_analytics(wide).collect()}
    assert float(true_sum[1]) == 11.0 and true_sum[2] is None


def key_digest(texts):
    """The definition, row by row: md5 of the count and of the sums of both halves of each md5."""
    each = [hashlib.md5(t.encode()).hexdigest() for t in texts]
    high, low = (sum(int(x[at : at + 16], 16) for x in each) for at in (0, 16))
    return hashlib.md5(f"{len(each)}:{high}:{low}".encode()).hexdigest()


def test_digests_have_one_definition_at_all_sizes(spark):
    tables = {
        "small": spark.range(100).select("id"),
        "large": spark.range(70_000).select("id"),
        "pairs": spark.createDataFrame([(1, 2), (1, 3)], "a bigint, b bigint"),
        "empty": spark.range(0),
    }
    keys = {"small": ("id",), "large": ("id",), "pairs": ("a", "b"), "empty": ("id",)}
    got = {r.table_name: tuple(r)[1:] for r in digest.table_digests(tables, keys).collect()}
    assert got["small"] == (100, 0, 99, key_digest(map(str, range(100))))
    assert got["large"] == (70_000, 0, 69_999, key_digest(map(str, range(70_000))))
    assert got["pairs"] == (2, None, None, key_digest(["1:2", "1:3"]))
    assert got["empty"] == (0, None, None, None)


def test_digest_sees_repeats_and_lost_ids_but_no_order(spark):
    ids = [-70_000, -5, 0, 1, 65_535, 65_536, 65_536, 5_000_000_000]

    def checksum(values):
        df = spark.createDataFrame([(i,) for i in values], "id bigint")
        return digest.table_digests({"t": df}, {"t": ("id",)}).first().checksum_md5

    whole = checksum(ids)
    assert whole == key_digest(map(str, ids)) == checksum(ids[::-1])
    assert len({whole, checksum(ids[1:]), checksum([*ids, 1]), checksum([*ids, 1, 1])}) == 4


def test_table_diff(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", "d")], "id bigint, name string, description string")
    b = spark.createDataFrame([(1, "x", "new"), (2, "z", "d"), (3, "w", None)], "id bigint, name string, description string")
    got = {(r.id, r.field): r.status for r in compare.table_diff(a, b, ENTITIES["tags"]).collect()}
    assert got == {(1, "description"): "missing", (2, "name"): "mismatch", (3, "id"): "missing", (3, "name"): "missing"}
    every = compare.table_diff(a, b, ENTITIES["tags"], matches=True)
    assert every.filter("status = 'match'").count() == 5


def test_file_lookups(spark):
    mb = 1024 * 1024
    rows = [(1, 9, "a", 11 * mb, "pdf"), (2, 9, "b", 10 * mb, None), (3, 8, "c", 25 * mb + 5000, "pdf")]
    df = spark.createDataFrame(rows, "id bigint, contact_id bigint, file_name string, file_size bigint, mime_type string")
    df = df.withColumns({"created_at": F.col("id"), "file_path": F.lit("/p"), "file_hash": F.lit("h")})
    assert [(r.file_name, float(r.file_size_mb)) for r in files.large_files(df).collect()] == [("c", 25.0), ("a", 11.0)]
    assert [r.file_name for r in files.files_by_type(df, "pdf").collect()] == ["c", "a"]
    stats = files.file_stats(df).first()
    assert (stats.total_files, stats.contacts_with_files, stats.files_by_type) == (3, 2, {"pdf": 2, "unknown": 1})
    assert files.contact_file_summary(df, 9).first().file_types == {"pdf": 1, "unknown": 1}
    people = spark.createDataFrame([(9, "A", "B", "e")], "id bigint, given_name string, family_name string, email string")
    assert [r.id for r in files.files_with_contacts(df, people).collect()] == [2, 1]


# --- sources and sinks -----------------------------------------------------------------

TEXTS = [
    "plain", "with, comma", 'with "quotes"', "line\nbreak", "carriage\rreturn", "tab\there", " leading",
    "trailing ", ' "mixed", all\nof it ', "", None, 'back\\"slash', "back\\", '"', "ünïcode",
]


def test_csv_round_trip(spark):
    rows = [(i, t, i % 2 == 0) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "id int, body string, flag boolean")
    folder = work_dir(spark, "csv")
    assert exports.export_csv(df, folder) == len(TEXTS)
    back = exports.read_csv_export(spark, folder, df.schema).orderBy("id").collect()
    assert [r.body for r in back] == [t or None for t in TEXTS]
    assert [r.flag for r in back] == [r[2] for r in rows]


def test_csv_text(spark):
    df = spark.sql(
        "SELECT 1 AS id, 'a \"b\", c' AS t, true AS ok, array(1, 2) AS l, named_struct('k', 'v') AS s,"
        " CAST(NULL AS STRING) AS n, CAST(2.50 AS DECIMAL(10,2)) AS d"
    )
    folder = work_dir(spark, "csv")
    exports.export_csv(df, folder)
    text = "".join(open(p, newline="").read() for p in glob.glob(f"{folder}/part-*.csv"))
    assert text == 'id,t,ok,l,s,n,d\n1,"a ""b"", c",true,1; 2,"{""k"":""v""}",,2.50\n'


def test_empty_export_leaves_no_file(spark):
    folder = work_dir(spark, "csv")
    assert exports.export_csv(spark.range(0), folder) == 0
    assert glob.glob(f"{folder}*") == []


def test_parquet_has_structured_lists(spark):
    df = spark.createDataFrame([(1, "[1,2]", '[{"email":"a","field":"W"}]')], "id int, tag_ids string, email_addresses string")
    folder = work_dir(spark, "parquet")
    assert exports.export_parquet(df, folder) == 1
    row = spark.read.parquet(folder).first()
    assert row.tag_ids == [1, 2] and row.email_addresses[0].email == "a"


def test_one_failing_table_does_not_stop_the_export(spark):
    def broken():
        raise RuntimeError("no such table")

    every = {"b": broken, "a": lambda: spark.range(3), "c": lambda: spark.range(0), "d": lambda: spark.range(5)}
    got = exports.export_all(spark, every, work_dir(spark, "all"), "csv", where="id > 0", limit=2).collect()
    assert [(r.table_name, r.status, r.rows) for r in got] == [("a", "ok", 2), ("b", "error", 0), ("c", "empty", 0), ("d", "ok", 2)]
    with pytest.raises(ValueError):
        exports.export_all(spark, every, "x", "xml")


def test_contact_dataset_export(spark):
    from clientele.sources.bindings import CrmTables

    t = CrmTables(spark, "/root/testdata/sf0.001")
    folder = work_dir(spark, "analytics")
    assert exports.export_analytics(t, f"{folder}/parquet") == 150
    assert "tag_count" in spark.read.parquet(f"{folder}/parquet").columns
    assert exports.export_analytics(t, f"{folder}/csv", "csv", limit=7) == 7
    head = spark.read.text(f"{folder}/csv").first().value
    assert head.startswith("id,given_name,family_name,email,") and head.count(",") == 18
    assert exports.export_entity(t["contact_tags"], f"{folder}/tags", "csv", "tag_id = 3") > 0


def test_scan_and_search(spark):
    df = spark.createDataFrame([(1, "Ann", None, "a@x"), (2, None, "Mann", "b@x"), (3, "Bo", "Lu", "ANN@x"), (4, "Al", "Z", None)],
                               "id bigint, given_name string, family_name string, email string")
    assert [r.id for r in tables.search_contacts(df, "ann").collect()] == [3, 2, 1]
    assert [r.id for r in tables.search_contacts(df, "ann", 1).collect()] == [3]
    assert [r.id for r in tables.scan_entity(df, "id > 1", 2).collect()] == [2, 3]
    assert tables.lookup_record(df, 4).first().given_name == "Al"
    assert [r.id for r in tables.browse_entity(df, 2).collect()] == [4, 3]


def test_filters_and_columns_reach_the_scan(spark):
    from clientele.operators.flatten import delta_since
    from clientele.sources.bindings import CrmTables

    t = CrmTables(spark, "/root/testdata/sf0.001")
    log = t.star("orders").selectExpr("o_orderkey AS id", "o_orderdate AS created_at", "o_orderdate AS updated_at")
    plan = delta_since(log, "1998-01-01T00:00:00Z").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan.split("PushedFilters")[1]
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
