"""Validation rules on small tables with planted defects."""

import pytest

from clientele.operators import checks, contacts
from clientele.plans.catalog import ORPHAN_CHECKS
from clientele.plans.specs import ENTITIES, LOAD_ORDER
from clientele.plans.validation import CHECKS, validation_summary

ORPHANS = {
    "orphan_contact_tags": 3, "orphan_contacts": 2, "orphan_opportunities": 3,
    "opps_missing_stage": 1, "opps_missing_pipeline": 2, "orphan_tasks": 3,
    "tasks_missing_parents": 2, "orphan_notes": 3, "notes_missing_parents": 3, "orphan_orders": 1,
    "orphan_order_items": 2, "orphan_payments": 1, "orphan_stages": 1,
}


@pytest.mark.parametrize("name", ORPHANS)
def test_orphans(shop, name):
    child, columns = ORPHAN_CHECKS[name]
    check = checks.OrphanCheck(ENTITIES[child], columns)
    assert checks.orphan_count(shop, check).first()[0] == ORPHANS[name]


def test_fk_report(spark, shop):
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup(None))
    report = checks.fk_report(shop)
    summary = validation_summary(shop)
    assert len(jobs.getJobIdsForGroup(None)) == before  # nothing has run yet
    assert "HashAggregate" in report._jdf.queryExecution().toString() and summary.columns[0] == "check_name"
    got = {r.table_name: r.orphan_count for r in report.collect()}
    assert got["Orphaned contact_tags"] == 3 and got["Orphaned stages"] == 1
    assert len(got) == 9


def test_orphan_rows_keep_every_column_and_duplicate_parents_do_not_multiply(spark, shop):
    twice = {**shop, "contacts": shop["contacts"].unionByName(shop["contacts"])}
    notes = checks.OrphanCheck(ENTITIES["notes"])
    lost = checks.orphan_rows(twice, notes, checks.lost_keys(twice, [notes]))
    assert lost.columns == shop["notes"].columns
    assert sorted(r.id for r in lost.collect()) == [2, 3, 4]


def test_a_lost_key_with_a_third_of_the_rows(spark, shop):
    """Hot lost keys in two columns, some rows with both: each row counts once."""
    tasks = spark.range(60_000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 77 ELSE 1 END AS contact_id",
        "CASE WHEN id % 2 = 0 THEN 88 END AS opportunity_id", "CAST(NULL AS BIGINT) AS owner_id",
        "'t' AS title",
    )
    check = checks.OrphanCheck(ENTITIES["tasks"])
    tables = {**shop, "tasks": tasks}
    lost = checks.lost_keys(tables, [check]).collect()
    assert sorted((r.fk, r.key, r.rows) for r in lost) == [("contact_id", 77, 20_000), ("opportunity_id", 88, 30_000)]
    assert checks.orphan_count(tables, check).first()[0] == 40_000


def test_samples_cut_long_bodies(spark, shop):
    notes = shop["notes"].selectExpr("*", "CAST(NULL AS TIMESTAMP) AS created_at")
    rows = checks.orphan_note_samples({**shop, "notes": notes}).collect()
    assert [(r.id, len(r.body)) for r in rows] == [(2, 103), (4, 5)]


def test_row_rules(shop):
    def ids(df):
        return sorted(r[0] for r in df.collect())

    assert ids(checks.missing_company_name(shop["companies"])) == [2, 3]
    assert ids(checks.missing_contact_names(shop["contacts"])) == [2, 4]
    assert ids(checks.json_shape_check(shop["contacts"])) == [3, 4]
    mismatch = checks.stage_pipeline_mismatch(shop["opportunities"], shop["stages"])
    assert [tuple(r) for r in mismatch.collect()] == [(4, 2, 9)]


def test_commerce_rules(shop):
    diff = checks.order_reconciliation(shop["orders"], shop["order_items"]).collect()
    assert [(r.id, float(r["diff"])) for r in diff] == [(2, -0.02)]
    over = checks.overpaid_orders(shop["orders"], shop["payments"]).collect()
    assert [(r.id, float(r.paid)) for r in over] == [(2, 60.0)]


def test_declared_rules(shop):
    nulls = {(r.table_name, r.column_name): r.null_rows for r in checks.not_null_report(shop, list(LOAD_ORDER)).collect()}
    assert nulls[("stages", "name")] == 1 and nulls[("tasks", "title")] == 1
    assert nulls[("payments", "amount")] == 1 and nulls[("products", "name")] == 0
    keys = {e.name: e.key for e in LOAD_ORDER}
    dupes = {r.table_name: r.duplicate_groups for r in checks.key_uniqueness_report(shop, keys).collect()}
    assert dupes["order_items"] == 1 and sum(dupes.values()) == 1


def test_enumeration(spark):
    runs = spark.createDataFrame([("running",), ("done",), (None,)], "status string")
    assert checks.allowed_values_check(runs, "status", ("running", "success")).count() == 1


def test_summary_counts_and_survives_a_broken_check(shop):
    rows = {r.check_name: r for r in validation_summary(shop).collect()}
    assert rows["opps_missing_stage"].outcome == "1 issues"
    assert rows["TOTAL"].outcome == "failed"
    assert rows["TOTAL"].issue_count == sum(r.issue_count for n, r in rows.items() if n != "TOTAL")
    without = {k: v for k, v in shop.items() if k != "payments"}
    rows = {r.check_name: r for r in validation_summary(without).collect()}
    assert rows["overpaid_orders"].outcome == "error" and len(rows) == len(CHECKS) + 1
    without = {k: v for k, v in shop.items() if k != "pipelines"}
    rows = {r.check_name: r for r in validation_summary(without).collect()}
    assert rows["opps_missing_pipeline"].outcome == "error"
    assert rows["opps_missing_stage"].outcome == "1 issues"


def test_summary_passes_on_clean_data(shop):
    only = {"opps": checks.OrphanCheck(ENTITIES["opportunities"], ("contact_id",))}
    clean = {**shop, "opportunities": shop["opportunities"].filter("id = 1")}
    rows = {r.check_name: r.outcome for r in validation_summary(clean, only).collect()}
    assert rows == {"opps": "clean", "TOTAL": "passed"}


def test_duplicate_emails_give_a_row_per_contact(spark):
    rows = [(i, '[{"email":"A@x","field":"Work"}]') for i in range(0, 200_000, 8)]
    rows += [(i, '[{"email":"b@x","field":"Work"},{"email":"B@x","field":"EMAIL"}]') for i in (3, 1)]
    rows += [(5, '[{"email":"single@x","field":"Work"}]')]
    df = spark.createDataFrame(rows, "id bigint, email_addresses string")
    got = contacts.duplicate_emails(df).orderBy("email", "contact_id").collect()
    big = [r for r in got if r.email == "a@x"]
    assert [r.contact_id for r in big] == list(range(0, 200_000, 8))
    assert {(r.dupes, r.times) for r in big} == {(25_000, 1)}
    small = [(r.dupes, r.contact_id, r.times) for r in got if r.email == "b@x"]
    assert small == [(4, 1, 2), (4, 3, 2)] and {r.email for r in got} == {"a@x", "b@x"}
    assert {r.email for r in contacts.duplicate_emails(df, limit=1).collect()} == {"a@x"}
