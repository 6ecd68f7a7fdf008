"""SQL for the registered queries, run by the correctness check on the same tables."""

from __future__ import annotations

from clientele.plans.oracle_views import with_views
from clientele.plans.specs import ENTITIES, FLAG, ID, JSON, TIME

_SQL_TYPES = {ID: "BIGINT", TIME: "TIMESTAMP", FLAG: "BOOLEAN", JSON: "VARCHAR", "string": "VARCHAR"}


def _flat(entity: str, source: str, **values: str) -> str:
    """Every column of a flattened entity: the given expressions, defaults elsewhere."""
    columns = []
    for field in ENTITIES[entity].fields:
        default = f"'{field.default}'" if field.default else "NULL"
        kind = _SQL_TYPES.get(field.type, "DOUBLE")
        columns.append(f"CAST({values.pop(field.name, default)} AS {kind}) AS {field.name}")
    assert not values, values
    return f"SELECT {', '.join(columns)} FROM {source}"


def _stamp(moment: str, key: str) -> str:
    return (
        f"CASE WHEN ({key}) % 50 = 9 THEN NULL WHEN ({key}) % 3 = 2 THEN {moment} - INTERVAL 2 HOUR"
        f" ELSE {moment} END"
    )


def _day(key: str, days: int = 365) -> str:
    return f"(TIMESTAMP '2023-01-01' + to_days(CAST({key} % {days} AS INTEGER)))"


def _orphans(child: str, refs: list[tuple[str, str]], where_null: bool = False) -> str:
    joins = " ".join(
        f"LEFT JOIN {parent} p{i} ON p{i}.id = c.{column}" for i, (column, parent) in enumerate(refs)
    )
    lost = " OR ".join(
        f"(p{i}.id IS NULL)" if where_null else f"(c.{column} IS NOT NULL AND p{i}.id IS NULL)"
        for i, (column, _) in enumerate(refs)
    )
    return f"SELECT count(*) AS n FROM {child} c {joins} WHERE {lost}"


_CONTACT, _OPP, _OWNER = ("contact_id", "v_contacts"), ("opportunity_id", "v_opportunities"), ("owner_id", "v_users")
_COMPANY = ("company_id", "v_companies")
_STAGE, _PIPE = ("stage_id", "v_stages"), ("pipeline_id", "v_pipelines")
_TAGS = _orphans("v_contact_tags", [_CONTACT, ("tag_id", "v_tags")], where_null=True)

_ORPHANS: dict[str, str] = {
    "orphan_contact_tags": _TAGS,
    "orphan_contacts": _orphans("v_contacts", [_COMPANY, _OWNER]),
    "orphan_opportunities": _orphans("v_opportunities", [_CONTACT, _COMPANY, _OWNER, _PIPE, _STAGE]),
    "opps_missing_stage": _orphans("v_opportunities", [_STAGE]),
    "opps_missing_pipeline": _orphans("v_opportunities", [_PIPE]),
    "orphan_tasks": _orphans("v_tasks", [_CONTACT, _OPP, _OWNER]),
    "tasks_missing_parents": _orphans("v_tasks", [_CONTACT, _OPP]),
    "orphan_notes": _orphans("v_notes", [_CONTACT, _OPP, _OWNER]),
    "notes_missing_parents": _orphans("v_notes", [_CONTACT, _OPP]),
    "orphan_orders": _orphans("v_orders", [_CONTACT]),
    "orphan_order_items": _orphans("v_order_items", [("order_id", "v_orders"), ("product_id", "v_products")]),
    "orphan_payments": _orphans("v_payments", [("order_id", "v_orders")]),
    "orphan_stages": _orphans("v_stages", [_PIPE]),
}

_MISMATCH = """
    SELECT o.id AS opportunity_id, o.pipeline_id AS opp_pipeline_id,
           s.pipeline_id AS stage_pipeline_id
    FROM v_opportunities o JOIN v_stages s ON s.id = o.stage_id
    WHERE o.pipeline_id IS NOT NULL AND s.pipeline_id IS NOT NULL
      AND o.pipeline_id <> s.pipeline_id"""
_RECONCILE = """
    SELECT o.id, o.total, sum(coalesce(i.subtotal, i.unit_price * i.quantity)) AS calc_subtotal,
           o.total - sum(coalesce(i.subtotal, i.unit_price * i.quantity)) AS diff
    FROM v_orders o LEFT JOIN v_order_items i ON i.order_id = o.id
    GROUP BY o.id, o.total
    HAVING abs(o.total - sum(coalesce(i.subtotal, i.unit_price * i.quantity))) > 0.01"""
_OVERPAID = """
    SELECT o.id, o.total, coalesce(sum(p.amount), 0) AS paid
    FROM v_orders o LEFT JOIN v_payments p ON p.order_id = o.id
    GROUP BY o.id, o.total HAVING coalesce(sum(p.amount), 0) > o.total + 0.01"""
_EMAILS = """
    SELECT id, lower(e.email) AS email FROM (
      SELECT id, unnest(from_json(email_addresses, '[{"email":"VARCHAR","field":"VARCHAR"}]')) AS e
      FROM v_contacts)
    WHERE e.email IS NOT NULL AND e.email <> ''
      AND coalesce(e.field, '') IN ('EMAIL1','EMAIL','PRIMARY','Work','work','Other','Primary')"""
_EXACT = """
    SELECT email FROM v_contacts WHERE email IS NOT NULL GROUP BY email HAVING count(*) > 1"""
_NO_COMPANY = "SELECT id FROM v_companies WHERE coalesce(name, '') = ''"
_NO_NAMES = """
    SELECT id FROM v_contacts
    WHERE coalesce(given_name, '') = '' AND coalesce(family_name, '') = ''"""
_SHAPE = """
    SELECT id FROM v_contacts
    WHERE list_contains(json_keys(raw), 'email_addresses')
      AND (email_addresses IS NULL OR json_array_length(email_addresses) = 0)"""

_CHECKS: dict[str, str] = {
    "contact_tags_missing_contact_or_tag": _TAGS,
    "opps_missing_stage": _ORPHANS["opps_missing_stage"],
    "opps_missing_pipeline": _ORPHANS["opps_missing_pipeline"],
    "tasks_missing_parents": _ORPHANS["tasks_missing_parents"],
    "notes_missing_parents": _ORPHANS["notes_missing_parents"],
    "stage_pipeline_mismatch": f"SELECT count(*) AS n FROM ({_MISMATCH})",
    "order_reconciliation": f"SELECT count(*) AS n FROM ({_RECONCILE})",
    "overpaid_orders": f"SELECT count(*) AS n FROM ({_OVERPAID})",
    "duplicate_emails": (
        f"SELECT count(*) AS n FROM (SELECT email FROM ({_EMAILS}) GROUP BY email HAVING count(*) > 1)"
    ),
    "missing_company_name": f"SELECT count(*) AS n FROM ({_NO_COMPANY})",
    "missing_contact_names": f"SELECT count(*) AS n FROM ({_NO_NAMES})",
    "json_shape_check": f"SELECT count(*) AS n FROM ({_SHAPE})",
}
_ALL_CHECKS = " UNION ALL ".join(
    f"SELECT '{name}' AS check_name, n AS issue_count FROM ({sql})" for name, sql in _CHECKS.items()
)

_TABLES = (
    "users", "pipelines", "stages", "tags", "companies", "contacts", "contact_tags",
    "opportunities", "tasks", "notes", "products", "orders", "order_items", "payments",
)


def _count_union(names, label: str, number: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS {label}, count(*) AS {number} FROM v_{n}" for n in names
    )


_ANALYTICS = """
    WITH o AS (SELECT contact_id, count(*) AS n, sum(value) AS v FROM v_opportunities GROUP BY 1),
    k AS (SELECT contact_id, count(DISTINCT id) AS n FROM v_tasks GROUP BY 1),
    t AS (SELECT contact_id, count(DISTINCT id) AS n FROM v_notes GROUP BY 1),
    g AS (SELECT contact_id, count(DISTINCT tag_id) AS n FROM v_contact_tags GROUP BY 1)
    SELECT c.id AS contact_id, {head}
      coalesce(o.n, 0) AS opportunity_count, coalesce(k.n, 0) AS task_count,
      coalesce(t.n, 0) AS note_count, coalesce(g.n, 0) AS tag_count,
      CAST({total} AS DOUBLE) AS total_opportunity_value {tail}
    FROM v_contacts c LEFT JOIN v_companies co ON co.id = c.company_id
    LEFT JOIN v_users u ON u.id = c.owner_id
    LEFT JOIN o ON o.contact_id = c.id LEFT JOIN k ON k.contact_id = c.id
    LEFT JOIN t ON t.contact_id = c.id LEFT JOIN g ON g.contact_id = c.id"""

_KEY_CHECKSUM = """
    md5(concat_ws(':', count(*),
      CAST(sum(CAST(CAST('0x' || substr(md5({key}), 1, 16) AS UBIGINT) AS HUGEINT)) AS VARCHAR),
      CAST(sum(CAST(CAST('0x' || substr(md5({key}), 17, 16) AS UBIGINT) AS HUGEINT)) AS VARCHAR)))"""
_ORDERED_DIGEST = f"""
    SELECT table_name, count(*) AS row_count, min(id) AS id_min, max(id) AS id_max,
      {_KEY_CHECKSUM.format(key="CAST(id AS VARCHAR)")} AS checksum_md5
    FROM ids GROUP BY table_name"""
#: Tables after two loads of overlapping parts; the second one completes them.
_TWO_LOADS = " UNION ALL ".join(
    f"SELECT CAST({run} AS BIGINT) AS run_id, '{name}' AS table_name, id FROM v_{name} WHERE {part}"
    for name in ("users", "contacts", "opportunities", "products")
    for run, part in ((1, "id % 3 < 2"), (2, "TRUE"))
)
_ROLLING_DIGEST = f"""
    SELECT 'contact_tags' AS table_name, count(*) AS row_count, CAST(NULL AS BIGINT) AS id_min,
      CAST(NULL AS BIGINT) AS id_max, {_KEY_CHECKSUM.format(key="contact_id || ':' || tag_id")} AS checksum_md5
    FROM v_contact_tags"""

_PERFORMANCE = """
    SELECT {run} entity, count(*) AS total_pages, CAST(sum(item_count) AS BIGINT) AS total_items,
      CAST(sum(duration_ms) AS BIGINT) AS total_duration_ms,
      round(avg(duration_ms), 6) AS avg_page_duration_ms, {minmax}
      count(*) FILTER (throttle_remaining < 100) AS throttle_hits, {retry}
      count(error_message) AS error_count,
      round(CASE WHEN sum(duration_ms) > 0 THEN sum(item_count) * 1000.0::DOUBLE / sum(duration_ms)
                 ELSE 0 END, 6) AS throughput_items_per_second
    FROM v_request_metrics {where} GROUP BY ALL"""
_LATEST_RUN = "(SELECT id FROM v_run_log ORDER BY started_at DESC, id DESC LIMIT 1)"
_TYPES = """string_agg('"' || type || '":' || n, ',' ORDER BY type)"""

_MERGED_OPPS = """
    WITH every AS (SELECT id, contact_id, name, value, status, created_at FROM v_opportunities),
    updates AS (
      SELECT id, contact_id, name, value + 1 AS value,
        CASE WHEN id % 3 = 0 THEN 'Y' WHEN id % 5 = 0 THEN NULL ELSE 'X' END AS status, created_at
      FROM every WHERE created_at >= TIMESTAMP '1996-07-01')
    SELECT id, contact_id, name, CAST(value AS DOUBLE) AS value, status, created_at FROM updates
    UNION ALL
    SELECT id, contact_id, name, CAST(value AS DOUBLE), status, created_at FROM every
    WHERE created_at < TIMESTAMP '1997-01-01' AND id NOT IN (SELECT id FROM updates)"""

_BASE_TAGS = """
    SELECT DISTINCT id AS contact_id, tag_id FROM (
      SELECT id, unnest([1 + id % 25, 1 + id * 7 % 25, 1 + id % 5]) AS tag_id FROM v_contacts)"""

_KEPT = {
    "contacts": "id % 50 != 3", "tags": "id % 9 != 4", "orders": "id % 40 != 5", "products": "id % 30 != 7",
    "pipelines": "id != 2", "opportunities": "id % 70 != 8", "companies": "id % 5 != 1",
}


def _thinned_orphans(child: str) -> str:
    def kept(table: str) -> str:
        return f"(SELECT * FROM v_{table} WHERE {_KEPT.get(table, 'TRUE')})"

    keys = ENTITIES[child].foreign_keys
    return _orphans(kept(child), [(r.column, kept(r.parent)) for r in keys], where_null=child == "contact_tags")


# entity -> the test table its raw records are made of, their number, and their key
_LANDED: dict[str, tuple[str, str, str]] = {
    "users": ("supplier", "s_suppkey", "k"),
    "pipelines": ("region", "r_regionkey", "k"),
    "stages": ("nation", "n_nationkey", "k"),
    "tags": ("part", "p_partkey", "k"),
    "companies": ("supplier", "s_suppkey", "k"),
    "contacts": ("customer", "c_custkey", "k"),
    "contact_tags": ("orders", "o_orderkey", "o_custkey || ':' || o_orderkey % 25"),
    "opportunities": ("orders", "o_orderkey", "k"),
    "tasks": ("events", "event_id", "k"),
    "notes": ("conversations", "conv_id * 1000 + turn", "k"),
    "products": ("part", "p_partkey", "k"),
    "orders": ("orders", "o_orderkey", "k"),
    "order_items": ("lineitem", "l_orderkey * 10 + l_linenumber", "k"),
    "payments": ("lineitem WHERE l_returnflag = 'R'", "l_orderkey * 10 + l_linenumber", "k"),
}


def _loaded(entity: str, position: int) -> str:
    """One row of a load's manifest and the rows the table holds; links between contacts and tags have no id to lose."""
    table, number, key = _LANDED[entity]
    bad = "(13)" if entity == "contact_tags" else "(11, 13)"
    return (
        f"SELECT CAST({position} AS BIGINT) AS position, '{entity}' AS entity, 'loaded' AS status,"
        f" count(*) FILTER (k % 60 NOT IN {bad}) AS rows, count(*) FILTER (k % 60 IN {bad}) AS rejected,"
        f" count(DISTINCT {key}) FILTER (k % 60 NOT IN {bad}) AS stored FROM (SELECT *, {number} AS k FROM {table})"
    )


def _attempt(attempt: int, position: int, entity: str) -> str:
    return (
        f"SELECT CAST({attempt} AS BIGINT) AS attempt, position, entity, status, rows, rejected,"
        f" 'completed' AS progress, rows AS total_items_processed FROM ({_loaded(entity, position)})"
    )


_ORACLE: dict[str, str] = {
    # sources and sinks
    "ingest_pages": """
        SELECT c_custkey AS id, c_name AS given_name, CAST(c_nationkey AS BIGINT) AS company_id,
          '[' || (c_custkey % 25) || ',' || (c_custkey * 7 % 25) || ']' AS tag_ids FROM customer""",
    "exact_numbers": """
        WITH amounts AS (SELECT o_orderkey AS id, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS total FROM orders),
        parts AS (SELECT id, total, 'at 1.50' AS currency,
            '[{"id":1,"rate":' || total || '000000000000000000}]' AS custom_fields FROM amounts)
        SELECT id, '{"id":' || id || ',"total":' || total || ',"currency":"at 1.50","custom_fields":' || custom_fields || '}' AS raw,
          total, currency, custom_fields FROM parts""",
    "scan_entity": """
        SELECT * REPLACE (CAST(score_value AS DOUBLE) AS score_value) FROM v_contacts
        WHERE owner_id > 50 AND country_code = 'CA' ORDER BY id LIMIT 500""",
    "json_payload_column": """
        SELECT id, '{"id":' || id || ',"name":"' || name || '","created_at":"'
          || strftime(created_at, '%Y-%m-%dT%H:%M:%S') || '"}' AS raw FROM v_opportunities
        UNION ALL SELECT id, '{"id":' || id || ',"name":"' || name || '"}' FROM v_stages
        UNION ALL SELECT id, '{"id":' || id || ',"name":"' || name || '"}' FROM v_tags""",
    "export_csv": "SELECT id, contact_id, title, body, created_at FROM v_notes",
    "export_parquet": """
        SELECT id, email, CAST(3 AS BIGINT) AS tags, 1 + id % 25 AS first_tag,
          CASE WHEN id % 40 NOT IN (3, 5) THEN 'EMAIL1' END AS first_label FROM v_contacts""",
    "export_all": "SELECT table_name, 'parquet' AS format, 'ok' AS status, rows FROM ("
    + _count_union(_TABLES, "table_name", "rows") + ")",
    # flattening
    "flatten_base": f"""
        SELECT s_suppkey AS id, {_stamp(_day('s_suppkey'), 's_suppkey')} AS created_at,
          {_stamp(_day('s_suppkey', 90), 's_suppkey + 1')} AS updated_at,
          'u' || s_suppkey || '@staff.test' AS raw_email FROM supplier""",
    "flatten_users": _flat(
        "users", "supplier", id="s_suppkey", given_name="s_name",
        family_name="CASE WHEN s_suppkey % 4 != 0 THEN 'N' || s_nationkey END",
        email="'u' || s_suppkey || '@staff.test'",
        created_at=_stamp(_day("s_suppkey"), "s_suppkey"),
        updated_at=_stamp(_day("s_suppkey", 90), "s_suppkey + 1"),
    ),
    "flatten_pipelines": _flat(
        "pipelines", "region", id="r_regionkey", name="r_name",
        created_at=_stamp(_day("r_regionkey"), "r_regionkey"),
    ),
    "flatten_stages": _flat(
        "stages", "nation", id="n_nationkey", pipeline_id="n_regionkey", name="n_name"
    ),
    "flatten_tags": _flat(
        "tags", "part", id="p_partkey", name="p_brand",
        description="CASE WHEN p_partkey % 2 = 0 THEN p_name END",
    ),
    "flatten_companies": _flat(
        "companies", "supplier", id="s_suppkey", name="s_name",
        website="'https://s' || s_suppkey || '.test'",
        phone="CASE s_suppkey % 3 WHEN 0 THEN '555-' || s_suppkey WHEN 1 THEN '556-' || s_suppkey END",
        address="CASE WHEN s_suppkey % 7 != 0 THEN s_suppkey || ' Dock' END",
        city="CASE WHEN s_suppkey % 7 != 0 THEN 'Port' END",
        state="CASE WHEN s_suppkey % 7 != 0 THEN 'R' || s_nationkey END",
        postal_code="CASE WHEN s_suppkey % 7 != 0 THEN 'Z' || s_suppkey END",
        country_code="CASE WHEN s_suppkey % 7 != 0 THEN 'US' END",
        custom_fields="CASE WHEN s_suppkey % 2 = 0 THEN '{\"tier\":\"gold\"}' ELSE '{}' END",
        updated_at=_stamp(_day("s_suppkey"), "s_suppkey"),
    ),
    "flatten_contacts": _flat(
        "contacts", "customer", id="c_custkey", company_id="c_nationkey", given_name="c_name",
        family_name="c_mktsegment",
        email="CASE WHEN c_custkey % 40 != 3 THEN c_mktsegment || c_custkey || '@x.test' END",
        phone="CASE WHEN c_custkey % 3 = 0 THEN '555-' || c_custkey END",
        address="c_custkey || ' Main St'", city="'City ' || (c_custkey % 40)",
        state="'S' || (c_custkey % 12)",
        postal_code="CASE WHEN c_custkey % 2 = 0 THEN 'P' ELSE 'Z' END || c_custkey",
        country_code="'US'", owner_id="c_custkey % 103",
        email_status="CASE WHEN c_custkey % 3 = 0 THEN 'SingleOptIn' END",
        email_opted_in="c_custkey % 2 = 0", score_value="CAST(c_acctbal AS DECIMAL(15,2))",
        tag_ids="'[' || (c_custkey % 25) || ',' || (c_custkey * 7 % 25) || ']'",
        email_addresses="""CASE WHEN c_custkey % 40 = 3 THEN '[]' ELSE '[{"email":"' || c_mktsegment
            || c_custkey || '@x.test","field":"EMAIL1"}]' END""",
        phone_numbers="""CASE WHEN c_custkey % 3 = 0 THEN '[{"number":"555-' || c_custkey
            || '","type":"Work"}]' ELSE '[]' END""",
        addresses="""'[{"line1":"' || c_custkey || ' Main St","locality":"City ' || (c_custkey % 40)
            || '","region":"S' || (c_custkey % 12) || '"'
            || CASE WHEN c_custkey % 2 = 0 THEN ',"postal_code":"P' || c_custkey || '"' ELSE '' END
            || ',"zip_code":"Z' || c_custkey || '","country_code":"US"}]'""",
        created_at=_stamp(_day("c_custkey"), "c_custkey"),
        updated_at=_stamp(_day("c_custkey", 90), "c_custkey + 1"),
    ),
    "flatten_contact_tags": _flat(
        "contact_tags", "orders", contact_id="o_custkey", tag_id="o_orderkey % 25",
        created_at=_stamp("o_orderdate", "o_orderkey"),
    ),
    "flatten_opportunities": _flat(
        "opportunities", "orders", id="o_orderkey", contact_id="o_custkey",
        name="'Deal \"' || o_orderkey || '\"'", description="o_orderpriority",
        stage_id="o_orderkey % 27", pipeline_id="o_orderkey % 6",
        value="CAST(o_totalprice AS DECIMAL(15,2))", status="o_orderstatus",
        owner_id="o_orderkey % 101", created_at=_stamp("o_orderdate", "o_orderkey"),
        updated_at=_stamp("o_orderdate", "o_orderkey + 1"),
    ),
    "flatten_tasks": _flat(
        "tasks", "events", id="event_id", contact_id="user_id", opportunity_id="event_id * 2",
        title="event_type", description="props", type="'Call'", priority="event_id % 3",
        due_date="ts", completed_date="CASE WHEN event_id % 2 = 0 THEN date_trunc('day', ts) END",
        owner_id="event_id % 107", created_at=_stamp(_day("event_id"), "event_id"),
    ),
    "flatten_notes": _flat(
        "notes", "conversations", id="conv_id * 1000 + turn", contact_id="conv_id * 20",
        title="role", body="text || chr(10) || '\"' || role || chr(92)", note_type="'Other'",
        owner_id="turn", created_at=_stamp(_day("conv_id"), "conv_id"),
        updated_at=_stamp(_day("conv_id"), "turn"),
    ),
    "flatten_products": _flat(
        "products", "part", id="p_partkey", name="p_name", description="p_type",
        price="CAST(p_retailprice AS DECIMAL(15,2))", currency="'USD'",
        sku="p_brand || '/' || p_size", status="CASE WHEN p_size % 2 = 0 THEN 'ACTIVE' END",
    ),
    "flatten_orders": _flat(
        "orders", "orders", id="o_orderkey", contact_id="o_custkey",
        order_number="'ORD-' || o_orderkey", order_date="o_orderdate",
        total="CAST(o_totalprice AS DECIMAL(15,2))", status="o_orderstatus",
        order_status="o_orderstatus",
        shipping_address="""'{"line1":"' || o_orderpriority || '"}'""",
        created_at=_stamp("o_orderdate", "o_orderkey"),
    ),
    "flatten_order_items": _flat(
        "order_items", "lineitem", id="l_orderkey * 10 + l_linenumber", order_id="l_orderkey",
        product_id="l_partkey", name="'item ' || l_partkey",
        unit_price="CAST(l_extendedprice AS DECIMAL(15,2))", quantity="l_quantity",
        subtotal="CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_extendedprice AS DECIMAL(15,2)) END",
    ),
    "flatten_payments": _flat(
        "payments", "lineitem WHERE l_returnflag = 'R'", id="l_orderkey * 10 + l_linenumber",
        order_id="l_orderkey", amount="CAST(l_extendedprice AS DECIMAL(15,2))",
        payment_date="l_shipdate", payment_method="'CARD'", transaction_id="'T' || l_orderkey",
        status="CASE WHEN l_linenumber % 2 = 0 THEN 'PAID' END",
    ),
    "parse_timestamps": f"""
        SELECT o_orderkey AS id, CASE WHEN o_orderkey % 50 = 9 THEN 'not-a-date'
            ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
              || CASE o_orderkey % 3 WHEN 0 THEN 'Z' WHEN 1 THEN '.000+0000' ELSE '+02:00' END END
            AS text, {_stamp('o_orderdate', 'o_orderkey')} AS parsed FROM orders""",
    "quarantine_bad_records": """
        SELECT CASE c_custkey % 60 WHEN 11 THEN 'rejected: no key' WHEN 13 THEN 'rejected: unparseable'
            ELSE 'loaded' END AS outcome, count(*) AS records FROM customer GROUP BY 1""",
    # filters
    "delta_since": """
        SELECT id, created_at, updated_at FROM v_contacts
        WHERE created_at >= TIMESTAMP '2023-09-01' OR updated_at >= TIMESTAMP '2023-09-01'""",
    "where_clause_export": """
        SELECT id, contact_id, CAST(value AS DOUBLE) AS value FROM v_opportunities
        WHERE value > 100000 AND status = 'O'""",
    "search_contacts": """
        SELECT id, given_name, family_name, email FROM v_contacts
        WHERE given_name ILIKE '%mach%' OR family_name ILIKE '%mach%' OR email ILIKE '%mach%'
        ORDER BY id DESC LIMIT 200""",
    "search_companies": """
        SELECT id, name, website FROM v_companies WHERE name ILIKE '%nation_1%'
        ORDER BY id DESC LIMIT 100""",
    "lookup_record": "SELECT id, given_name, email, created_at FROM v_contacts WHERE id = 77",
    "missing_company_name": f"{_NO_COMPANY} ORDER BY id LIMIT 100",
    "missing_contact_names": f"{_NO_NAMES} ORDER BY id LIMIT 100",
    "json_shape_check": f"{_SHAPE} ORDER BY id LIMIT 100",
    "large_files": """
        SELECT contact_id, file_name, file_size AS file_size_bytes,
          round(file_size / 1048576.0, 2)::DOUBLE AS file_size_mb, mime_type, created_at
        FROM v_contact_files WHERE file_size > 10 * 1024 * 1024""",
    "files_by_type": """
        SELECT contact_id, file_name, file_size AS file_size_bytes, file_path, created_at
        FROM v_contact_files WHERE mime_type = 'fr'""",
    "allowed_values_check": """
        SELECT 'run_log' AS table_name, 'status' AS column_name, count(*) AS bad_rows FROM v_run_log
          WHERE status NOT IN ('running', 'success', 'error')
        UNION ALL SELECT 'progress', 'status', count(*) FROM v_progress WHERE status = 'completed'
        UNION ALL SELECT 'checkpoints', 'checkpoint_type', count(*) FROM v_checkpoint_events
          WHERE checkpoint_type NOT IN ('page', 'batch', 'entity')""",
    # joins
    "contacts_with_relationships": """
        SELECT c.id, c.given_name, c.family_name, c.email, c.phone, c.address, c.city, c.state,
          c.postal_code, c.country_code, c.email_status, c.email_opted_in,
          CAST(c.score_value AS DOUBLE) AS score_value, co.name AS company_name,
          co.website AS company_website, u.email AS owner_email, u.given_name AS owner_name,
          c.created_at, c.updated_at
        FROM v_contacts c LEFT JOIN v_companies co ON c.company_id = co.id
        LEFT JOIN v_users u ON c.owner_id = u.id""",
    "contact_analytics": _ANALYTICS.format(
        head="""c.given_name, c.family_name, c.email, c.email_status, c.email_opted_in,
          CAST(c.score_value AS DOUBLE) AS score_value, co.name AS company_name,
          co.website AS company_website, u.email AS owner_email,""",
        total="o.v", tail=", c.created_at, c.updated_at",
    ),
    "contact_analytics_fanout": _ANALYTICS.format(
        head="",
        total="o.v * greatest(coalesce(k.n, 0), 1) * greatest(coalesce(t.n, 0), 1)"
        " * greatest(coalesce(g.n, 0), 1)",
        tail="",
    ),
    "spot_check_counts": """
        SELECT c.id, c.given_name, c.family_name,
          (SELECT count(*) FROM v_contact_tags x WHERE x.contact_id = c.id) AS tag_count,
          (SELECT count(*) FROM v_opportunities x WHERE x.contact_id = c.id) AS opp_count,
          (SELECT count(*) FROM v_tasks x WHERE x.contact_id = c.id) AS task_count
        FROM (SELECT * FROM v_contacts ORDER BY md5(id || 'spot-check'), id LIMIT 20) c""",
    "random_sample": """
        SELECT id, given_name, family_name FROM v_contacts
        ORDER BY md5(id || 'spot-check'), id LIMIT 20""",
    "files_with_contacts": """
        SELECT f.*, c.given_name, c.family_name, c.email
        FROM v_contact_files f JOIN v_contacts c ON f.contact_id = c.id""",
    "new_files_only": """
        WITH known AS (SELECT DISTINCT contact_id, file_hash FROM v_contact_files
                       WHERE file_path < '/store/src15')
        SELECT f.id, f.contact_id, f.file_hash FROM v_contact_files f LEFT JOIN known k
          ON k.contact_id = f.contact_id AND k.file_hash = f.file_hash WHERE k.file_hash IS NULL""",
    "stage_pipeline_mismatch": f"{_MISMATCH} ORDER BY opportunity_id LIMIT 100",
    "explode_contact_emails": _EMAILS,
    "tag_links": _BASE_TAGS,
    "interrupted_runs": """
        SELECT id, started_at FROM v_run_log r WHERE status = 'running' AND EXISTS (
          SELECT 1 FROM v_progress p
          WHERE p.run_id = r.id AND p.status IN ('pending', 'running', 'failed'))
        ORDER BY started_at DESC, id DESC LIMIT 1""",
    "last_successful_run": """
        SELECT e.entity, coalesce((
          SELECT max_by(r.id, r.started_at) FROM v_run_log r JOIN v_progress p ON p.run_id = r.id
          WHERE p.entity = e.entity AND p.status = 'completed' AND r.status = 'success'), 0)
          AS last_run_id
        FROM (SELECT DISTINCT entity FROM v_progress) e""",
    "snapshot_delta": """
        WITH ranked AS (SELECT table_name, row_count,
            row_number() OVER (PARTITION BY table_name ORDER BY run_id DESC) AS rn
          FROM v_snapshots WHERE schema_name = 'crm')
        SELECT cur.table_name, cur.row_count AS current_rows, prev.row_count AS previous_rows,
          cur.row_count - coalesce(prev.row_count, 0) AS delta
        FROM ranked cur LEFT JOIN ranked prev ON prev.table_name = cur.table_name AND prev.rn = 2
        WHERE cur.rn = 1""",
    "table_diff": """
        WITH old AS (SELECT * REPLACE (
            CASE WHEN id % 17 = 0 THEN 'old.' || email ELSE email END AS email,
            CASE WHEN id % 19 != 0 THEN city END AS city) FROM v_contacts WHERE id % 97 != 5),
        pairs AS (SELECT n.id, f.field, f.a AS left_value, f.b AS right_value
          FROM v_contacts n LEFT JOIN old o ON o.id = n.id, LATERAL (
            SELECT unnest(['id', 'given_name', 'family_name', 'email', 'phone', 'address', 'city',
                'state', 'postal_code', 'country_code', 'owner_id']) AS field,
              unnest([CAST(o.id AS VARCHAR), o.given_name, o.family_name, o.email, o.phone, o.address,
                o.city, o.state, o.postal_code, o.country_code, CAST(o.owner_id AS VARCHAR)]) AS a,
              unnest([CAST(n.id AS VARCHAR), n.given_name, n.family_name, n.email, n.phone, n.address,
                n.city, n.state, n.postal_code, n.country_code, CAST(n.owner_id AS VARCHAR)]) AS b) f)
        SELECT id, field, left_value, right_value,
          CASE WHEN left_value IS NULL OR right_value IS NULL THEN 'missing' ELSE 'mismatch' END
            AS status
        FROM pairs WHERE left_value IS DISTINCT FROM right_value""",
    # validation
    **{
        name: f"SELECT '{name}' AS check_name, n AS orphans FROM ({sql})"
        for name, sql in _ORPHANS.items()
    },
    "fk_report": " UNION ALL ".join(
        f"SELECT 'Orphaned {n}' AS table_name, n AS orphan_count FROM ({_ORPHANS['orphan_' + n]})"
        for n in ("contact_tags", "contacts", "opportunities", "tasks", "notes", "orders",
                  "order_items", "payments", "stages")
    ),
    "fk_report_thinned": " UNION ALL ".join(
        f"SELECT 'Orphaned {n}' AS table_name, n AS orphan_count FROM ({_thinned_orphans(n)})"
        for n in ("contact_tags", "contacts", "opportunities", "tasks", "notes", "orders",
                  "order_items", "payments", "stages")
    ),
    "orphan_note_samples": """
        SELECT n.id, n.contact_id, CASE WHEN length(n.body) > 100 THEN substr(n.body, 1, 100) || '...'
            ELSE n.body END AS body, n.created_at
        FROM v_notes n LEFT JOIN v_contacts c ON n.contact_id = c.id
        WHERE c.id IS NULL AND n.contact_id IS NOT NULL ORDER BY n.id LIMIT 10""",
    "dashboard_checks": f"""
        SELECT ({_orphans('v_notes', [_CONTACT])}) AS orphaned_notes,
          ({_orphans('v_tasks', [_CONTACT])}) AS orphaned_tasks,
          (SELECT count(*) FROM ({_EXACT})) AS duplicate_emails""",
    "union_checks": _ALL_CHECKS,
    "validation_summary": f"""
        WITH each_check AS ({_ALL_CHECKS})
        SELECT check_name, issue_count,
          CASE WHEN issue_count = 0 THEN 'clean' ELSE issue_count || ' issues' END AS outcome
        FROM each_check
        UNION ALL SELECT 'TOTAL', CAST(sum(issue_count) AS BIGINT),
          CASE WHEN sum(issue_count) = 0 THEN 'passed' ELSE 'failed' END FROM each_check""",
    "not_null_report": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS null_rows FROM v_{t}"
        for t, c in (("pipelines", "name"), ("stages", "name"), ("tags", "name"),
                     ("companies", "name"), ("tasks", "title"), ("products", "name"),
                     ("order_items", "name"), ("payments", "amount"))
    ),
    "key_uniqueness_report": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS duplicate_groups FROM"
        f" (SELECT {k} FROM v_{t} GROUP BY {k} HAVING count(*) > 1)"
        for t, k in [(t, "contact_id, tag_id" if t == "contact_tags" else "id") for t in _TABLES]
        + [("run_log", "id"), ("source_counts", "run_id, entity"),
           ("snapshots", "run_id, schema_name, table_name"), ("progress", "run_id, entity"),
           ("contact_files", "contact_id, file_hash")]
    ),
    # aggregations
    "freshness_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS tbl, count(*) AS n, "
        + ("max(updated_at)" if t in ("users", "contacts", "opportunities") else "CAST(NULL AS TIMESTAMP)")
        + f" AS max_updated_at FROM v_{t}"
        for t in _TABLES
    ),
    "order_reconciliation": f"""
        SELECT id, CAST(total AS DOUBLE) AS total, CAST(calc_subtotal AS DOUBLE) AS calc_subtotal,
          CAST(diff AS DOUBLE) AS diff FROM ({_RECONCILE}) ORDER BY abs(diff) DESC, id LIMIT 100""",
    "overpaid_orders": f"""
        SELECT id, CAST(total AS DOUBLE) AS total, CAST(paid AS DOUBLE) AS paid FROM ({_OVERPAID})
        ORDER BY paid - total DESC, id LIMIT 100""",
    "duplicate_emails": f"""
        WITH e AS ({_EMAILS}),
        top AS (SELECT email, count(*) AS dupes FROM e GROUP BY email HAVING count(*) > 1
                ORDER BY dupes DESC, email LIMIT 100)
        SELECT email, dupes, id AS contact_id, count(*) AS times FROM e JOIN top USING (email)
        GROUP BY ALL""",
    "duplicate_exact_emails": f"SELECT count(*) AS duplicate_groups FROM ({_EXACT})",
    "coverage_totals": """
        SELECT (SELECT count(*) FROM v_contacts) AS contacts,
          (SELECT count(*) FROM v_contact_tags) AS tag_links,
          (SELECT count(*) FROM v_opportunities) AS opportunities,
          (SELECT count(*) FROM v_tasks) AS tasks, (SELECT count(*) FROM v_notes) AS notes""",
    "coverage_distinct": """
        SELECT (SELECT count(DISTINCT contact_id) FROM v_contact_tags) AS contacts_with_tags,
          (SELECT count(DISTINCT contact_id) FROM v_opportunities) AS contacts_with_opps,
          (SELECT count(DISTINCT contact_id) FROM v_tasks) AS contacts_with_tasks""",
    "entity_counts": _count_union(
        ("contacts", "companies", "opportunities", "tasks", "notes", "tags", "users"),
        "entity", "row_count",
    ),
    "run_metrics": """
        SELECT r.id AS run_id, count(q.id) AS total_requests,
          CAST(coalesce(sum(q.item_count), 0) AS BIGINT) AS total_items,
          CAST(coalesce(sum(q.duration_ms), 0) AS BIGINT) AS total_duration_ms,
          count(q.error) AS error_count, count(*) FILTER (q.throttled) AS throttle_count
        FROM v_run_log r LEFT JOIN v_request_log q ON q.run_id = r.id GROUP BY r.id""",
    "entity_performance": _PERFORMANCE.format(
        run="run_id,", where="",
        minmax="min(duration_ms) AS min_page_duration_ms, max(duration_ms) AS max_page_duration_ms,",
        retry="CAST(sum(retry_count) AS BIGINT) AS retry_attempts,",
    ),
    "run_performance_summary": _PERFORMANCE.format(
        run="", where=f"WHERE run_id = {_LATEST_RUN}", minmax="", retry=""
    ),
    "throttle_analysis": """
        SELECT run_id, entity, endpoint, throttle_type, count(*) AS throttle_events,
          round(avg(throttle_remaining), 6) AS avg_throttle_remaining,
          CAST(sum(wait_time_ms) AS BIGINT) AS total_wait_time_ms
        FROM v_throttle_events GROUP BY ALL""",
    "error_analysis": """
        SELECT run_id, entity, error_type, count(*) AS error_count,
          min(error_message) AS sample_error_message
        FROM v_error_events GROUP BY ALL""",
    "file_stats": f"""
        SELECT count(*) AS total_files, CAST(sum(file_size) AS BIGINT) AS total_size_bytes,
          round(sum(file_size) / 1048576.0, 2)::DOUBLE AS total_size_mb,
          count(DISTINCT contact_id) AS contacts_with_files,
          round(avg(file_size), 2) AS avg_file_size_bytes,
          (SELECT '{{' || {_TYPES} || '}}' FROM (SELECT coalesce(mime_type, 'unknown') AS type,
             count(*) AS n FROM v_contact_files GROUP BY 1)) AS files_by_type
        FROM v_contact_files""",
    "contact_file_summary": f"""
        SELECT contact_id, CAST(sum(n) AS BIGINT) AS total_files,
          CAST(sum(bytes) AS BIGINT) AS total_size_bytes, '{{' || {_TYPES} || '}}' AS file_types
        FROM (SELECT contact_id, coalesce(mime_type, 'unknown') AS type, count(*) AS n,
                sum(file_size) AS bytes FROM v_contact_files GROUP BY 1, 2) GROUP BY contact_id""",
    "table_digest": f"""
        WITH ids AS (SELECT 'orders' AS table_name, id FROM v_orders) {_ORDERED_DIGEST.strip()}
        UNION ALL {_ROLLING_DIGEST}""",
    "snapshot_all": "WITH ids AS ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, id FROM v_{t}" for t in _TABLES if t != "contact_tags"
    )
    + f""") {_ORDERED_DIGEST.strip().replace('SELECT table_name, count(*) AS row_count',
        "SELECT (SELECT max(id) FROM v_run_log) AS run_id, 'crm' AS schema_name, table_name, count(*) AS row_count")}
        UNION ALL {_ROLLING_DIGEST.replace("SELECT 'contact_tags'",
        "SELECT (SELECT max(id) FROM v_run_log), 'crm', 'contact_tags'")}""",
    "stored_snapshots": f"""
        SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY run_id DESC) AS rn FROM (
          SELECT run_id, 'crm' AS schema_name, table_name, count(*) AS row_count, min(id) AS id_min, max(id) AS id_max,
            {_KEY_CHECKSUM.format(key="CAST(id AS VARCHAR)")} AS checksum_md5
          FROM ({_TWO_LOADS}) GROUP BY run_id, table_name)""",
    "stored_snapshot_delta": f"""
        SELECT table_name, count(*) FILTER (run_id = 2) AS current_rows, count(*) FILTER (run_id = 1) AS previous_rows,
          count(*) FILTER (run_id = 2) - count(*) FILTER (run_id = 1) AS delta
        FROM ({_TWO_LOADS}) GROUP BY table_name""",
    "file_sync_totals": """
        WITH known AS (SELECT DISTINCT contact_id, file_hash FROM v_contact_files
                       WHERE file_path < '/store/src15'),
        copies AS (SELECT f.contact_id, f.file_hash, count(*) AS found,
            CASE WHEN any_value(k.file_hash) IS NULL THEN 1 ELSE 0 END AS stored
          FROM v_contact_files f LEFT JOIN known k
            ON k.contact_id = f.contact_id AND k.file_hash = f.file_hash GROUP BY 1, 2)
        SELECT contact_id, CAST(sum(found) AS BIGINT) AS files_found,
          CAST(sum(stored) AS BIGINT) AS files_stored,
          CAST(sum(found) - sum(stored) AS BIGINT) AS files_skipped
        FROM copies GROUP BY ROLLUP (contact_id)""",
    "source_vs_loaded": "WITH held AS ("
    + _count_union(("contacts", "companies", "orders", "users", "tasks"), "entity", "rows_loaded")
    + """) SELECT s.run_id, s.entity, s.items_retrieved, h.rows_loaded
        FROM v_source_counts s LEFT JOIN held h ON h.entity = s.entity""",
    # windows, sorts, limits
    "rank_snapshots": """
        SELECT table_name, row_count, run_id,
          row_number() OVER (PARTITION BY table_name ORDER BY run_id DESC) AS rn
        FROM v_snapshots""",
    "latest_per_key": """
        SELECT run_id, entity, seq, status FROM v_progress_events
        QUALIFY row_number() OVER (PARTITION BY run_id, entity ORDER BY at_time DESC, seq DESC) = 1""",
    "latest_checkpoint": """
        SELECT run_id, entity, checkpoint_type, checkpoint_data FROM v_checkpoint_events
        QUALIFY row_number() OVER (PARTITION BY run_id, entity, checkpoint_type
                                   ORDER BY created_at DESC, seq DESC) = 1""",
    "recent_runs": """
        SELECT id, status, started_at, finished_at, notes FROM v_run_log
        ORDER BY started_at DESC, id DESC LIMIT 10""",
    "run_durations": """
        SELECT id, status, started_at, finished_at, notes,
          (epoch_us(finished_at) - epoch_us(started_at)) / 1e6 AS duration_seconds
        FROM v_run_log ORDER BY started_at DESC, id DESC LIMIT 10""",
    "request_metrics_for_run": f"""
        SELECT entity, endpoint, item_count, duration_ms, throttle_remaining FROM v_request_metrics
        WHERE run_id = {_LATEST_RUN}""",
    "system_health_for_run": f"""
        SELECT metric_name, CAST(metric_value AS DOUBLE) AS metric_value, metric_unit, tags,
          recorded_at FROM v_system_health WHERE run_id = {_LATEST_RUN}""",
    "browse_entity": """
        SELECT id, name, CAST(value AS DOUBLE) AS value, created_at FROM v_opportunities
        ORDER BY id DESC LIMIT 100""",
    "entities_to_resume": """
        WITH run AS (SELECT id FROM v_run_log r WHERE status = 'running' AND EXISTS (
            SELECT 1 FROM v_progress p
            WHERE p.run_id = r.id AND p.status IN ('pending', 'running', 'failed'))
          ORDER BY started_at DESC, id DESC LIMIT 1)
        SELECT entity AS entity_name, last_page_offset, last_page_limit
        FROM v_progress JOIN run ON run.id = run_id
        WHERE status IN ('pending', 'running', 'failed')""",
    # writes
    "merge_entity": _MERGED_OPPS,
    "merge_new_column": f"""
        SELECT *, CASE WHEN created_at >= TIMESTAMP '1996-07-01'
            THEN 'import ' || CASE WHEN id % 3 = 0 THEN 2 ELSE 1 END END AS source
        FROM ({_MERGED_OPPS})""",
    "merge_contact_tags": f"""
        WITH listed AS ({_BASE_TAGS})
        SELECT contact_id, tag_id, 'listed' AS source FROM listed
        UNION ALL SELECT contact_id, tag_id, 'bought' FROM (
          SELECT contact_id, tag_id FROM v_contact_tags EXCEPT SELECT contact_id, tag_id FROM listed)""",
    "merge_files": """
        WITH known AS (SELECT * FROM v_contact_files WHERE file_path < '/store/src15'
            QUALIFY row_number() OVER (PARTITION BY contact_id, file_hash
                                       ORDER BY created_at DESC, id DESC) = 1),
        rows AS (SELECT *, -1 AS seq, CAST(NULL AS TIMESTAMP) AS written FROM known
          UNION ALL SELECT *, id AS seq, created_at + INTERVAL 1 DAY FROM v_contact_files)
        SELECT contact_id, file_hash, arg_min(id, seq) AS id,
          arg_min(remote_file_id, seq) AS remote_file_id, arg_min(created_at, seq) AS created_at,
          arg_max(file_name, seq) AS file_name, arg_max(file_path, seq) AS file_path,
          arg_max(file_size, seq) AS file_size,
          nullif(arg_max(coalesce(mime_type, '-'), seq), '-') AS mime_type,
          CASE WHEN count(*) > 1 THEN arg_max(written, seq) END AS updated_at
        FROM rows GROUP BY contact_id, file_hash""",
    "merge_source_counts": """
        SELECT run_id, entity, items_retrieved + CASE WHEN run_id > 15 THEN 7 ELSE 0 END
          AS items_retrieved FROM v_source_counts""",
    "merge_progress": """
        SELECT run_id, entity, arg_max(status, seq) AS status,
          arg_min(at_time, seq) FILTER (status = 'running') AS started_at,
          arg_max(at_time, seq) FILTER (status IN ('completed', 'failed')) AS completed_at,
          coalesce(arg_max(page_offset, seq) FILTER (page_offset IS NOT NULL), 0) AS last_page_offset,
          coalesce(arg_max(items_processed, seq) FILTER (items_processed IS NOT NULL), 0)
            AS total_items_processed,
          arg_max(error_message, seq) FILTER (error_message IS NOT NULL) AS error_message,
          arg_min(at_time, seq) AS created_at, arg_max(at_time, seq) AS updated_at
        FROM v_progress_events GROUP BY run_id, entity""",
    "merge_checkpoints": """
        SELECT run_id, entity, checkpoint_type, checkpoint_data, created_at FROM v_checkpoint_events
        QUALIFY row_number() OVER (PARTITION BY run_id, entity, checkpoint_type
          ORDER BY seq % 2 DESC, created_at DESC, seq DESC) = 1""",
    "run_log_fold": """
        SELECT id, started_at, finished_at, status,
          notes || CASE WHEN status = 'running' THEN '' ELSE chr(10) || 'finished ' || id END AS notes
        FROM v_run_log""",
    "append_metrics": """
        SELECT run_id, entity, count(*) AS rows, CAST(sum(remaining) AS BIGINT) AS remaining FROM (
          SELECT run_id, entity, throttle_remaining AS remaining FROM v_throttle_events
          UNION ALL SELECT run_id, entity, NULL FROM v_error_events) GROUP BY ALL""",
    "retention": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) FILTER ({c} IN (SELECT id FROM v_run_log WHERE started_at"
        f" >= TIMESTAMP '2024-01-17')) AS kept, count(*) FILTER ({c} NOT IN (SELECT id FROM v_run_log"
        f" WHERE started_at >= TIMESTAMP '2024-01-17')) AS removed FROM v_{t}"
        for t, c in (("run_log", "id"), ("request_log", "run_id"), ("source_counts", "run_id"),
                     ("snapshots", "run_id"), ("throttle_events", "run_id"), ("progress", "run_id"))
    ),
    "ordered_load": " UNION ALL ".join(_loaded(n, i) for i, n in enumerate(_TABLES)),
    "resumed_load": " UNION ALL ".join(
        [_attempt(1, 0, "users"), _attempt(1, 1, "tags")]
        + [
            f"SELECT 1 AS attempt, 2 AS position, entity, 'failed' AS status, 0 AS rows, 0 AS rejected, progress,"
            f" total_items_processed FROM ({_attempt(1, 2, 'companies')})"
        ]
        + [_attempt(2, i, n) for i, n in enumerate(("companies", "contacts", "products"))]
    ),
    "load_run_metrics": f"""
        WITH tried AS ({" UNION ALL ".join(_loaded(n, 0) for n in ("users", "tags", "companies", "contacts", "products"))}),
        requests AS (SELECT entity, rows + rejected AS items, 0 AS failed FROM tried UNION ALL SELECT 'companies', 0, 1)
        SELECT CAST(7 AS BIGINT) AS run_id, coalesce(entity, 'all') AS entity, count(*) AS requests,
          CAST(sum(items) AS BIGINT) AS total_items, CAST(sum(failed) AS BIGINT) AS error_count
        FROM requests GROUP BY ROLLUP (entity)""",
    "unread_values": """
        SELECT o_orderkey AS id, 'created_at' AS field, 'not-a-date' AS text FROM orders WHERE o_orderkey % 50 = 9
        UNION ALL SELECT o_orderkey, 'updated_at', 'not-a-date' FROM orders WHERE (o_orderkey + 1) % 50 = 9
        UNION ALL SELECT o_orderkey, 'value', '12 EUR' FROM orders WHERE o_orderkey % 40 = 7""",
    "stored_checkpoints": """
        SELECT run_id, entity, checkpoint_type, checkpoint_data, created_at FROM v_checkpoint_events
        QUALIFY row_number() OVER (PARTITION BY run_id, entity, checkpoint_type ORDER BY created_at DESC, seq DESC) = 1""",
    "incremental_stream": f"""
        SELECT c_custkey AS id, c_name AS given_name, CAST(c_nationkey AS BIGINT) AS company_id,
          CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 103 ELSE 7 END AS owner_id,
          {_stamp(_day('c_custkey', 90), 'c_custkey + 1')} AS updated_at FROM customer""",
}

ORACLE: dict[str, str] = {name: with_views(sql) for name, sql in _ORACLE.items()}
