"""API-shaped JSON records made from the star tables, one builder per entity.

They carry the irregularities real payloads show: nested or flat ids, an object or a string
under the same key, missing keys, empty lists, three date formats and dates that do not parse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.sources.bindings import STAR, CrmTables


def _stamp(moment: str, key: str) -> str:
    """A date in one of the landed formats, chosen by key; one key in fifty is no date."""
    text = f"date_format({moment}, \"yyyy-MM-dd'T'HH:mm:ss\")"
    return (
        f"CASE WHEN ({key}) % 50 = 9 THEN 'not-a-date' WHEN ({key}) % 3 = 0 THEN concat({text}, 'Z')"
        f" WHEN ({key}) % 3 = 1 THEN concat({text}, '.000+0000') ELSE concat({text}, '+02:00') END"
    )


def _day(key: str, days: int = 365) -> str:
    return f"TIMESTAMP_NTZ'2023-01-01' + make_dt_interval(CAST({key} % {days} AS INT))"


# entity -> (star table, filter, id expression, payload fields)
_SOURCES: dict[str, tuple[str, str | None, str, dict[str, str]]] = {
    "users": (
        "supplier", None, "s_suppkey",
        {
            "id": "s_suppkey",
            "given_name": "s_name",
            "family_name": "CASE WHEN s_suppkey % 4 != 0 THEN concat('N', s_nationkey) END",
            "email_address": "concat('u', s_suppkey, '@staff.test')",
            "date_created": _stamp(_day("s_suppkey"), "s_suppkey"),
            "last_updated": _stamp(_day("s_suppkey", 90), "s_suppkey + 1"),
        },
    ),
    "pipelines": (
        "region", None, "CAST(r_regionkey AS BIGINT)",
        {
            "id": "r_regionkey",
            "name": "r_name",
            "date_created": _stamp(_day("r_regionkey"), "r_regionkey"),
        },
    ),
    "stages": (
        "nation", None, "CAST(n_nationkey AS BIGINT)",
        {"id": "n_nationkey", "pipeline_id": "n_regionkey", "name": "n_name"},
    ),
    "tags": (
        "part", None, "p_partkey",
        {
            "id": "p_partkey",
            "name": "p_brand",
            "category": "named_struct('id', p_size, 'name', p_type)",
            "description": "CASE WHEN p_partkey % 2 = 0 THEN p_name END",
        },
    ),
    "companies": (
        "supplier", None, "s_suppkey",
        {
            "id": "s_suppkey",
            "company_name": "s_name",
            "website": "concat('https://s', s_suppkey, '.test')",
            "phone_number": (
                "CASE WHEN s_suppkey % 3 = 0 THEN to_json(named_struct('number',"
                " concat('555-', s_suppkey), 'type', 'Work')) WHEN s_suppkey % 3 = 1"
                " THEN concat('\"556-', s_suppkey, '\"') END"
            ),
            "address": (
                "CASE WHEN s_suppkey % 7 != 0 THEN to_json(named_struct('line1',"
                " concat(s_suppkey, ' Dock'), 'locality', 'Port', 'region', concat('R', s_nationkey),"
                " 'zip_code', concat('Z', s_suppkey), 'country_code', 'US')) ELSE 'null' END"
            ),
            "custom_fields": "CASE WHEN s_suppkey % 2 = 0 THEN '{\"tier\":\"gold\"}' END",
            "last_updated": _stamp(_day("s_suppkey"), "s_suppkey"),
        },
    ),
    "contacts": (
        "customer", None, "c_custkey",
        {
            "id": "c_custkey",
            "company": "CASE WHEN c_custkey % 2 = 0 THEN named_struct('id', c_nationkey) END",
            "company_id": "CASE WHEN c_custkey % 2 = 1 THEN c_nationkey END",
            "given_name": "c_name",
            "family_name": "c_mktsegment",
            "owner_id": "c_custkey % 103",
            "email_addresses": (
                "CASE WHEN c_custkey % 40 = 3 THEN array() ELSE array(named_struct('email',"
                " concat(c_mktsegment, c_custkey, '@x.test'), 'field', 'EMAIL1')) END"
            ),
            "phone_numbers": (
                "CASE WHEN c_custkey % 3 = 0 THEN array(named_struct('number',"
                " concat('555-', c_custkey), 'type', 'Work')) END"
            ),
            "addresses": (
                "array(named_struct('line1', concat(c_custkey, ' Main St'), 'locality',"
                " concat('City ', c_custkey % 40), 'region', concat('S', c_custkey % 12),"
                " 'postal_code', CASE WHEN c_custkey % 2 = 0 THEN concat('P', c_custkey) END,"
                " 'zip_code', concat('Z', c_custkey), 'country_code', 'US'))"
            ),
            "email_status": "CASE WHEN c_custkey % 3 = 0 THEN 'SingleOptIn' END",
            "email_opted_in": "c_custkey % 2 = 0",
            "ScoreValue": "CAST(c_acctbal AS DECIMAL(15,2))",
            "tag_ids": "array(c_custkey % 25, c_custkey * 7 % 25)",
            "date_created": _stamp(_day("c_custkey"), "c_custkey"),
            "last_updated": _stamp(_day("c_custkey", 90), "c_custkey + 1"),
        },
    ),
    "contact_tags": (
        "orders", None, "o_orderkey",
        {
            "contact_id": "o_custkey",
            "tag_id": "o_orderkey % 25",
            "date_created": _stamp("o_orderdate", "o_orderkey"),
        },
    ),
    "opportunities": (
        "orders", None, "o_orderkey",
        {
            "id": "o_orderkey",
            "opportunity_title": "concat('Deal \"', o_orderkey, '\"')",
            "opportunity_notes": "o_orderpriority",
            "contact": "named_struct('id', o_custkey, 'email', concat(o_custkey, '@x.test'))",
            "stage": "CASE WHEN o_orderkey % 2 = 0 THEN named_struct('id', o_orderkey % 27) END",
            "stage_id": "CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey % 27 END",
            "pipeline_id": "o_orderkey % 6",
            "projected_revenue_high": "CAST(o_totalprice AS DECIMAL(15,2))",
            "user": "named_struct('id', o_orderkey % 101)",
            "status": "o_orderstatus",
            "date_created": _stamp("o_orderdate", "o_orderkey"),
            "last_updated": _stamp("o_orderdate", "o_orderkey + 1"),
        },
    ),
    "tasks": (
        "events", None, "event_id",
        {
            "id": "event_id",
            "title": "event_type",
            "description": "props",
            "type": "'Call'",
            "priority": "event_id % 3",
            "contact": "named_struct('id', user_id)",
            "opportunity_id": "event_id * 2",
            "user_id": "event_id % 107",
            "due_date": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")",
            "completion_date": "CASE WHEN event_id % 2 = 0 THEN date_format(ts, 'yyyy-MM-dd') END",
            "creation_date": _stamp(_day("event_id"), "event_id"),
            "modification_date": "CASE WHEN event_id % 4 = 0 THEN '' ELSE '2024-02-30T00:00:00Z' END",
        },
    ),
    "notes": (
        "conversations", None, "conv_id * 1000 + turn",
        {
            "id": "conv_id * 1000 + turn",
            "body": "concat(text, '\\n\"', role, '\\\\')",
            "title": "role",
            "type": "'Other'",
            "user_id": "turn",
            "contact_id": "conv_id * 20",
            "date_created": _stamp(_day("conv_id"), "conv_id"),
            "last_updated": _stamp(_day("conv_id"), "turn"),
        },
    ),
    "products": (
        "part", None, "p_partkey",
        {
            "id": "p_partkey",
            "name": "p_name",
            "description": "p_type",
            "sku": "concat(p_brand, '/', p_size)",
            "price": "CAST(p_retailprice AS DECIMAL(15,2))",
            "currency": "'USD'",
            "status": "CASE WHEN p_size % 2 = 0 THEN 'ACTIVE' END",
        },
    ),
    "orders": (
        "orders", None, "o_orderkey",
        {
            "id": "o_orderkey",
            "contact": "named_struct('id', o_custkey)",
            "order_number": "concat('ORD-', o_orderkey)",
            "order_date": "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
            "total": "CAST(o_totalprice AS DECIMAL(15,2))",
            "status": "o_orderstatus",
            "shipping_address": "named_struct('line1', o_orderpriority)",
            "date_created": _stamp("o_orderdate", "o_orderkey"),
        },
    ),
    "order_items": (
        "lineitem", None, "l_orderkey * 10 + l_linenumber",
        {
            "id": "l_orderkey * 10 + l_linenumber",
            "order_id": "l_orderkey",
            "product_id": "l_partkey",
            "name": "concat('item ', l_partkey)",
            "quantity": "CAST(l_quantity AS INT)",
            "price": "CAST(l_extendedprice AS DECIMAL(15,2))",
            "total": "CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_extendedprice AS DECIMAL(15,2)) END",
        },
    ),
    "payments": (
        "lineitem", "l_returnflag = 'R'", "l_orderkey * 10 + l_linenumber",
        {
            "id": "l_orderkey * 10 + l_linenumber",
            "order_id": "l_orderkey",
            "amount": "CAST(l_extendedprice AS DECIMAL(15,2))",
            "payment_date": "date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
            "payment_method": "'CARD'",
            "transaction_id": "concat('T', l_orderkey)",
            "status": "CASE WHEN l_linenumber % 2 = 0 THEN 'PAID' END",
        },
    ),
}

# Values that are JSON already and go into the payload as they are.
_EMBEDDED = {("companies", "phone_number"), ("companies", "address"), ("companies", "custom_fields")}


def _needed(star: str, expressions: list[str]) -> list[str]:
    """The columns of a star table that the expressions mention."""
    names = [c.split()[0] for c in STAR[star].split(",")]
    return [n for n in names if any(n in e for e in expressions)]


def spread(rows: DataFrame) -> DataFrame:
    """Use all cores on a scan with fewer splits than cores; a large scan stays as it is."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def raw_records(tables: CrmTables, entity: str) -> DataFrame:
    """(id, raw): one JSON record per row of the entity's star table."""
    star, where, key, fields = _SOURCES[entity]
    rows = spread(tables.star(star).select(*_needed(star, [key, *fields.values(), where or ""])))
    if where:
        rows = rows.filter(where)
    plain = {n: e for n, e in fields.items() if (entity, n) not in _EMBEDDED}
    embedded = {n: e for n, e in fields.items() if (entity, n) in _EMBEDDED}
    body = "to_json(named_struct(" + ", ".join(f"'{n}', {e}" for n, e in plain.items()) + "))"
    if embedded:
        extra = ", ".join(
            f"coalesce(concat(',\"{n}\":', {e}), '')" for n, e in embedded.items()
        )
        body = f"concat(substring({body}, 1, length({body}) - 1), {extra}, '}}')"
    return rows.selectExpr(f"{key} AS id", f"{body} AS raw")


def defective_records(tables: CrmTables, entity: str) -> DataFrame:
    """The same records, some without their id and some cut off half-way."""
    cut = F.col("id") % 60
    without_id = F.regexp_replace("raw", r'"id":\d+,', "")
    return raw_records(tables, entity).withColumn(
        "raw",
        F.when(cut == 11, without_id).when(cut == 13, F.substring("raw", 1, 20)).otherwise(F.col("raw")),
    )
