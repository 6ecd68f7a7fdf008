"""Pages, flattening and quarantine."""

import json

from pyspark.sql import functions as F

from clientele.operators.flatten import (
    contact_emails, delta_since, flatten, good_rows, json_payload, load_outcome, rejected_rows,
    tag_links, with_reason,
)
from clientele.plans.specs import ENTITIES
from clientele.session import work_dir
from clientele.sources.pages import ingest_pages, unwrap_pages


def pages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def raws(spark, *records):
    texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
    return spark.createDataFrame([(t,) for t in texts], "raw string")


def test_page_shapes(spark):
    def ids(text):
        rows = unwrap_pages(pages(spark, text)).select(F.get_json_object("raw", "$.id")).collect()
        return [r[0] for r in rows]

    assert ids('{"contacts":[{"id":1,"name":"A"},{"id":2,"name":"B"}]}') == ["1", "2"]
    assert ids('  [{"id":1},{"id":2}]') == ["1", "2"]
    assert ids('{"contacts":[]}') == []
    assert ids('{"other":[{"id":1}]}') == []
    assert ids('{"contacts":{"id":5},"results":[{"id":3}]}') == ["3"]
    assert ids('{"users":[{"id":4}],"contacts":[{"id":3}]}') == ["3"]
    assert ids('{"contacts":[],"users":[{"id":4}]}') == []
    assert ids("not json") == []


EXACT = [
    r'{"id":1,"a":1.10,"b":1234567890123456789012345.678901234567890,"c":"x 1.50 \" 2.5","d":[1.0,-0.00,1e5,12E-3,-7,0,10]}',
    r'{"id":2,"s":"\u00015","t":"a\"\u00011.5","u":{"v":"\u0001"},"n":12345678901234567890123456789012345,"e":"\\","f":2.50}',
    '{"id":3,"long":"' + "y 1.25 " * 100_000 + r'\"","z":9.90}',
    '{"id":4,"x":"1.5"}',
    "{}",
]


def test_records_keep_their_text(spark):
    bodies = ['{"contacts":[' + ",".join(EXACT) + "]}", "[" + " , ".join(EXACT) + "]"]
    rows = unwrap_pages(pages(spark, *bodies, '{"contacts":[{"id":1.}]}', '1.5 "a')).collect()
    assert sorted((r.pos, r.raw) for r in rows) == sorted([*enumerate(EXACT)] * 2)


def test_fields_keep_all_digits(spark):
    text = ('{"id":1,"projected_revenue_high":9999999999999.10,"opportunity_title":"1.50","opportunity_notes":"\\u00012.50",'
            '"stage":{"id":3,"x":1.10},"custom_fields":[{"id":1,"content":1234567890123456789012345.10}]}')  # fmt: skip
    row = flatten(raws(spark, text), ENTITIES["opportunities"]).first()
    assert (str(row.value), row.name, row.description, row.stage_id) == ("9999999999999.10", "1.50", "\u00012.50", 3)
    assert row.custom_fields == '[{"id":1,"content":1234567890123456789012345.10}]'


def test_typing_is_compiled(spark):
    """A generated method of more than 8,000 bytes is never compiled by the JVM and runs interpreted."""
    for entity in ENTITIES.values():
        rows = with_reason(raws(spark, {"id": 1}), entity, unread=True)
        parts = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(rows._jdf.queryExecution().debug().codegenToSeq())
        assert all(part._3().maxMethodCodeSize() <= 8000 for part in parts), entity.name


def test_marks_of_every_kind_go(spark):
    text = ('{"id":1,"projected_revenue_high":-0,"opportunity_title":"\\u0001\\u00017","opportunity_notes":"a \\\\u00012.5 b",'
            '"custom_fields":{"a":"\\u00011","b":[1e2,-0,2.50,"3.10"]},"status":"1e5"}')  # fmt: skip
    row = flatten(raws(spark, text), ENTITIES["opportunities"]).first()
    assert (row.value, row.name, row.description, row.status) == (0, "\x01\x017", "a \\u00012.5 b", "1e5")
    assert row.custom_fields == '{"a":"\\u00011","b":[1e2,-0,2.50,"3.10"]}'
    whole = flatten(raws(spark, '{"id":2,"projected_revenue_high":3e2}', '{"id":3}'), ENTITIES["opportunities"])
    assert [(r.id, None if r.value is None else float(r.value)) for r in whole.orderBy("id").collect()] == [(2, 300.0), (3, None)]
    broken = ['{"id":1.5.5}', '{"id":-,"a":"x 1.5 y"}', '{"id":1,"a":1.', "1.5"]
    marked = with_reason(raws(spark, *broken), ENTITIES["opportunities"])
    assert {r.reason for r in marked.collect()} == {"unparseable"}


def test_pages_from_files(spark):
    folder = work_dir(spark, "pages")
    pages(spark, '{"tags":[{"id":1}]}', '[{"id":2}]').write.text(folder)
    rows = ingest_pages(spark, folder)
    assert rows.columns == ["page", "pos", "raw", "seq"]
    assert rows.count() == 2
    pretty = work_dir(spark, "pretty")
    spark.createDataFrame([('{"tags":\n [{"id":1},\n {"id":2}]}',)], "value string").coalesce(1).write.text(pretty)
    assert ingest_pages(spark, pretty, one_page_per_file=True).count() == 2


def test_contact_fields(spark):
    full = {
        "id": 1, "company": {"id": 7}, "given_name": "A", "owner_id": 3, "ScoreValue": "12.5",
        "email_addresses": [{"email": "a@x", "field": "EMAIL1"}, {"email": "b@x", "field": "EMAIL2"}],
        "phone_numbers": [{"number": "1-2", "type": "Work"}],
        "addresses": [{"line1": "L", "locality": "C", "region": "R", "zip_code": "Z", "country_code": "U"}],
        "tag_ids": [4, 5], "email_opted_in": True, "date_created": "2024-01-02T03:04:05Z",
        "last_updated": "2024-01-02T03:04:05.000+0000",
    }
    bare = {"id": 2, "company": None, "company_id": 9, "email_addresses": [], "tag_ids": None,
            "date_created": "yesterday", "last_updated": ""}
    odd = {"id": 3, "company": "Acme", "company_id": 8, "addresses": "none", "date_created": "T10:00"}
    rows = {r.id: r for r in flatten(raws(spark, full, bare, odd), ENTITIES["contacts"]).collect()}
    a, b, c = rows[1], rows[2], rows[3]
    assert (a.company_id, a.email, a.phone, a.address, a.postal_code) == (7, "a@x", "1-2", "L", "Z")
    assert (a.email_opted_in, float(a.score_value), a.tag_ids) == (True, 12.5, "[4,5]")
    assert a.created_at == a.updated_at and a.created_at.year == 2024
    assert json.loads(a.raw) == full
    assert (b.company_id, b.email, b.tag_ids, b.addresses) == (9, None, "[]", "[]")
    assert b.created_at is None and b.updated_at is None
    assert (c.company_id, c.city, c.created_at) == (8, None, None)


def test_company_with_null_address_or_text_phone_is_kept(spark):
    records = raws(
        spark,
        {"id": 1, "company_name": "A", "address": None, "phone_number": "555"},
        {"id": 2, "company_name": "B", "address": {"line1": "L", "postal_code": "P", "zip_code": "Z"},
         "phone_number": {"number": "556", "type": "Work"}},
        {"id": 3, "company_name": "C", "phone_number": {"type": "Work"}},
    )
    rows = {r.id: r for r in flatten(records, ENTITIES["companies"]).collect()}
    assert (rows[1].name, rows[1].address, rows[1].phone) == ("A", None, "555")
    assert (rows[2].address, rows[2].postal_code, rows[2].phone) == ("L", "P", "556")
    assert rows[3].phone is None


def test_path_fallbacks(spark):
    opp = {"id": 1, "contact": {"id": 5}, "stage": {"id": 6}, "user": {"id": 7},
           "opportunity_title": "T", "projected_revenue_high": 10.25, "last_updated": "2024-01-01"}
    r = flatten(raws(spark, opp), ENTITIES["opportunities"]).first()
    assert (r.contact_id, r.stage_id, r.owner_id, r.name, float(r.value)) == (5, 6, 7, "T", 10.25)
    assert r.updated_at is not None
    task = {"id": 2, "user_id": 3, "completion_date": "2024-01-01T00:00:00Z", "creation_date": "bad"}
    r = flatten(raws(spark, task), ENTITIES["tasks"]).first()
    assert r.owner_id == 3 and r.completed_date is not None and r.created_at is None
    item = {"id": 4, "order_id": 1, "price": 2.5, "quantity": 3, "total": 7.5}
    r = flatten(raws(spark, item), ENTITIES["order_items"]).first()
    assert (float(r.unit_price), float(r.quantity), float(r.subtotal)) == (2.5, 3.0, 7.5)


def test_bad_records_are_set_aside(spark):
    records = raws(spark, {"id": 1, "name": "a"}, {"name": "no id"}, '{"id": 3, "na', "[]", {"id": "x"})
    marked = with_reason(records, ENTITIES["tags"])
    assert [r.id for r in good_rows(marked).collect()] == [1]
    reasons = sorted(r.reason for r in rejected_rows(marked).collect())
    assert reasons == ["no key", "no key", "unparseable", "unparseable"]
    shapes = raws(spark, {"id": 1, "contact": "x", "stage": [1], "user": 5}, {"id": 2, "contact": {"id": 9}})
    marked = with_reason(shapes, ENTITIES["opportunities"]).orderBy("id").collect()
    assert [(r.id, r.contact_id, r.stage_id, r.reason) for r in marked] == [(1, None, None, None), (2, 9, None, None)]
    outcome = {r.outcome: r.records for r in load_outcome(records, ENTITIES["tags"]).collect()}
    assert outcome == {"loaded": 1, "rejected: no key": 2, "rejected: unparseable": 2}


def test_payload_is_parsed_once(spark):
    flat = flatten(raws(spark, {"id": 1}), ENTITIES["contacts"])
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(StructField(ScoreValue") == 1


def test_delta_since(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP'2024-01-01', NULL), (2, NULL, TIMESTAMP'2024-03-01'),"
        " (3, TIMESTAMP'2023-01-01', TIMESTAMP'2023-02-01'), (4, NULL, NULL)"
        " AS t(id, created_at, updated_at)"
    )

    def ids(since):
        return sorted(r.id for r in delta_since(rows, since).collect())

    assert ids("2024-01-01T00:00:00Z") == [1, 2]
    assert ids("2024-01-01T00:00:00+02:00") == [1, 2]
    assert ids("2024-02-01") == [2]
    assert ids("whenever") == [1, 2, 3, 4]


def test_emails_and_tags(spark, shop):
    got = sorted((r.id, r.email) for r in contact_emails(shop["contacts"]).collect())
    assert got == [(1, "a@x"), (2, "a@x")]
    lists = spark.createDataFrame([(1, "[3,3,4]"), (2, "[]"), (3, None)], "id bigint, tag_ids string")
    assert sorted((r[0], r[1]) for r in tag_links(lists).collect()) == [(1, 3), (1, 4)]


def test_payload_column_has_iso_dates(spark):
    row = json_payload(spark.sql("SELECT 1 AS id, TIMESTAMP'2024-01-02 03:04:05' AS t, NULL AS x"))
    assert json.loads(row.first().raw) == {"id": 1, "t": "2024-01-02T03:04:05Z", "x": None}


def test_the_last_record_of_a_key_is_loaded(spark, tmp_path):
    from clientele.plans.load import ordered_load
    from clientele.sources.pages import ingest_pages
    from clientele.sources.versions import VersionedTable

    pages = ['{"users":[{"id":1,"given_name":"old"},{"id":2,"given_name":"two"}]}', '{"users":[{"id":1,"given_name":"new"}]}']
    (tmp_path / "users").mkdir()
    (tmp_path / "users" / "pages.txt").write_text("\n".join(pages))
    store = str(tmp_path / "store")
    arrived = ingest_pages(spark, str(tmp_path / "users"))
    for records in (arrived, arrived, arrived.select("raw")):
        ordered_load(spark, store, {"users": records}, ["users"])
        rows = VersionedTable(spark, f"{store}/users", ("id",)).current().select("id", "given_name").collect()
        assert sorted(r.id for r in rows) == [1, 2]
        if "seq" in records.columns:
            assert {r.id: r.given_name for r in rows} == {1: "new", 2: "two"}


def test_payload_times_keep_microseconds(spark):
    from clientele.operators.flatten import json_payload

    rows = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-02 03:04:05.678901' AS a, TIMESTAMP_NTZ'2024-01-02 03:04:05' AS b")
    assert json_payload(rows).first().raw == '{"a":"2024-01-02T03:04:05.678901","b":"2024-01-02T03:04:05"}'
