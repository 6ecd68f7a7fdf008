"""The same table views as ``sources.bindings``, in SQL, for the correctness oracle."""

from __future__ import annotations

import re

_DAY = "CAST(extract(day FROM ts) AS BIGINT)"
_K = "CAST(regexp_extract(props, '\"k\": ?([0-9]+)', 1) AS BIGINT)"

VIEWS: dict[str, str] = {
    "v_users": """
        SELECT s_suppkey AS id, s_name AS given_name, 'Nation ' || s_nationkey AS family_name,
               'user' || s_suppkey || '@staff.test' AS email,
               TIMESTAMP '2020-01-01' + to_days(CAST(s_suppkey % 1000 AS INTEGER)) AS created_at,
               TIMESTAMP '2023-01-01' + to_days(CAST(s_suppkey % 60 AS INTEGER)) AS updated_at
        FROM supplier""",
    "v_pipelines": "SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name FROM region",
    "v_stages": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, CAST(n_regionkey AS BIGINT) AS pipeline_id,
               n_name AS name FROM nation""",
    "v_tags": """
        SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS id, p_brand AS name FROM part""",
    "v_companies": """
        SELECT CAST(n_nationkey AS BIGINT) AS id,
               CASE n_nationkey WHEN 24 THEN '' WHEN 23 THEN NULL ELSE n_name END AS name,
               'https://' || lower(n_name) || '.test' AS website
        FROM nation""",
    "v_contacts": """
        SELECT *,
          '{"id":' || id || ',"family_name":'
          || CASE WHEN family_name IS NULL THEN 'null' ELSE '"' || family_name || '"' END
          || CASE WHEN id % 80 = 45 THEN ',"email_addresses":null'
                  WHEN email_addresses IS NULL THEN ''
                  ELSE ',"email_addresses":' || email_addresses END
          || ',"tag_ids":' || tag_ids || '}' AS raw
        FROM (SELECT *,
            CASE WHEN id % 40 = 3 THEN '[]' WHEN id % 40 = 5 THEN NULL
                 ELSE '[{"email":"' || upper(email) || '","field":"EMAIL1"}'
                   || CASE WHEN id % 9 = 0 THEN
                        ',{"email":"alt' || (id % 50) || '@x.test","field":"Work"}'
                        || ',{"email":"","field":"EMAIL"}'
                        || ',{"email":"hidden' || id || '@x.test","field":"HOME"}' ELSE '' END
                   || ']' END AS email_addresses
          FROM (SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS company_id,
            CASE WHEN c_custkey % 50 = 7 THEN '' ELSE c_name END AS given_name,
            CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE c_mktsegment END AS family_name,
            lower(c_mktsegment) || (c_custkey % 700) || '@x.test' AS email,
            '555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone,
            (c_custkey % 300) || ' Main St' AS address,
            'City ' || (c_custkey % 40) AS city,
            'S' || (c_custkey % 12) AS state,
            lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postal_code,
            CASE WHEN c_custkey % 4 = 0 THEN 'CA' ELSE 'US' END AS country_code,
            c_custkey % 103 AS owner_id,
            CASE c_custkey % 3 WHEN 0 THEN 'SingleOptIn' WHEN 1 THEN 'NonMarketable' END
              AS email_status,
            c_custkey % 2 = 0 AS email_opted_in,
            CAST(c_acctbal AS DECIMAL(15,2)) AS score_value,
            '[' || (1 + c_custkey % 25) || ',' || (1 + c_custkey * 7 % 25) || ','
              || (1 + c_custkey % 5) || ']' AS tag_ids,
            TIMESTAMP '2023-01-01' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS created_at,
            CASE WHEN c_custkey % 11 != 0 THEN TIMESTAMP '2023-01-01'
              + to_days(CAST(c_custkey % 365 AS INTEGER)) + to_hours(c_custkey % 97) END
              AS updated_at
          FROM customer))""",
    "v_contact_tags": """
        SELECT DISTINCT o_custkey AS contact_id, CAST(substr(p_brand, 7) AS BIGINT) AS tag_id
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey""",
    "v_opportunities": """
        SELECT o_orderkey AS id, o_custkey AS contact_id,
          CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 26 END AS company_id,
          'Deal ' || o_orderkey AS name,
          o_orderkey % 27 AS stage_id, o_orderkey % 6 AS pipeline_id,
          CAST(o_totalprice AS DECIMAL(15,2)) AS value, o_orderstatus AS status,
          CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 101 END AS owner_id,
          o_orderdate AS created_at,
          o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER)) AS updated_at
        FROM orders""",
    "v_tasks": """
        SELECT event_id AS id, user_id * 11 AS contact_id, event_id * 2 AS opportunity_id,
          CASE WHEN event_id % 4 = 0 THEN event_id % 107 END AS owner_id,
          CASE WHEN event_id % 500 = 0 THEN NULL ELSE event_type END AS title,
          props AS description, ts AS due_date,
          CASE WHEN event_id % 2 = 0 THEN ts + to_days(1) END AS completed_date,
          ts AS created_at, ts + to_hours(event_id % 24) AS updated_at
        FROM events""",
    "v_notes": """
        SELECT conv_id * 1000 + turn AS id, conv_id * 20 AS contact_id,
          CASE WHEN turn % 2 = 0 THEN conv_id END AS opportunity_id,
          CASE WHEN turn = 0 THEN conv_id END AS owner_id,
          role AS title, text AS body,
          TIMESTAMP '2024-01-01' + to_hours(conv_id) + to_minutes(turn) AS created_at
        FROM conversations""",
    "v_products": """
        SELECT p_partkey AS id, p_name AS name, p_type AS description,
          CAST(p_retailprice AS DECIMAL(15,2)) AS price, p_brand || '/' || p_size AS sku,
          p_size % 2 = 0 AS active
        FROM part""",
    "v_lines": """
        SELECT *, (2 * cents + qty) // (2 * qty) AS unit_cents FROM (
          SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag, l_shipdate,
            CAST(l_quantity AS BIGINT) AS qty,
            CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
            CAST(round(l_discount * 100) AS BIGINT) AS off
          FROM lineitem)""",
    "v_order_items": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id,
          l_partkey AS product_id, 'item ' || l_partkey AS name,
          CAST(unit_cents * 0.01 AS DECIMAL(15,2)) AS unit_price,
          CAST(qty AS DECIMAL(10,2)) AS quantity,
          CASE WHEN l_linenumber % 2 = 1 THEN CAST(unit_cents * qty * 0.01 AS DECIMAL(15,2)) END
            AS subtotal
        FROM v_lines""",
    "v_orders": """
        SELECT o_orderkey AS id, o_custkey AS contact_id, 'ORD-' || o_orderkey AS order_number,
          o_orderdate AS order_date,
          CASE WHEN item_cents IS NULL THEN CAST(o_totalprice AS DECIMAL(15,2))
               ELSE CAST((item_cents + CASE WHEN o_orderkey % 10 = 0 THEN 500 ELSE 0 END) * 0.01
                         AS DECIMAL(15,2)) END AS total,
          o_orderstatus AS status, o_orderdate AS created_at
        FROM orders LEFT JOIN (
          SELECT l_orderkey AS order_id, CAST(sum(unit_cents * qty) AS BIGINT) AS item_cents
          FROM v_lines GROUP BY l_orderkey) ON o_orderkey = order_id""",
    "v_payments": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id,
          CAST(((cents * (100 - off) + 50) // 100) * 0.01 AS DECIMAL(15,2)) AS amount,
          l_shipdate AS payment_date, 'card' AS payment_method
        FROM v_lines WHERE l_returnflag = 'R'""",
    "v_contact_files": """
        SELECT doc_id AS id, n_chars % 200 AS contact_id, 'doc_' || doc_id || '.txt' AS file_name,
          '/store/' || source || '/' || doc_id AS file_path, n_chars * 1024 AS file_size,
          CASE WHEN doc_id % 19 != 0 THEN lang END AS mime_type, sha256(text) AS file_hash,
          'f' || doc_id AS remote_file_id,
          TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS created_at
        FROM documents""",
    "v_request_metrics": f"""
        SELECT event_id AS id, {_DAY} AS run_id, event_type AS entity,
          '/v1/' || event_type || '/' || (user_id % 3) AS endpoint,
          CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS http_status,
          {_K} AS item_count, CAST(floor(value * 10) AS BIGINT) AS duration_ms,
          {_K} * 2 AS throttle_remaining,
          CASE WHEN {_K} % 2 = 0 THEN 'minute' ELSE 'day' END AS throttle_type,
          event_id % 3 AS retry_count,
          CASE WHEN event_type = 'error' THEN 'failure ' || ({_K} % 7) END AS error_message,
          ts AS created_at
        FROM events""",
    "v_request_log": """
        SELECT id, run_id, endpoint, http_status, item_count, duration_ms,
          throttle_remaining < 100 AS throttled, error_message AS error, created_at
        FROM v_request_metrics""",
    "v_throttle_events": """
        SELECT id, run_id, entity, endpoint, throttle_type, throttle_remaining,
          (100 - throttle_remaining) * 10 AS wait_time_ms, created_at
        FROM v_request_metrics WHERE throttle_remaining < 100""",
    "v_error_events": """
        SELECT id, run_id, entity, endpoint, 'http_' || (http_status + item_count % 4) AS error_type,
          error_message, retry_count, created_at
        FROM v_request_metrics WHERE error_message IS NOT NULL""",
    "v_system_health": f"""
        SELECT event_id AS id, {_DAY} AS run_id, event_type || '_load' AS metric_name,
          CAST(value AS DECIMAL(38,6)) AS metric_value, 'ms' AS metric_unit, props AS tags,
          ts AS recorded_at
        FROM events""",
    "v_run_log": f"""
        SELECT id, started_at, CASE WHEN id % 3 != 0 THEN last_at END AS finished_at,
          CASE id % 3 WHEN 0 THEN 'running' WHEN 1 THEN 'success' ELSE 'error' END AS status,
          'run ' || id AS notes
        FROM (SELECT {_DAY} AS id, min(ts) AS started_at, max(ts) AS last_at
              FROM events GROUP BY 1)""",
    "v_progress": f"""
        SELECT run_id, entity,
          CASE (run_id + length(entity)) % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'running'
               WHEN 2 THEN 'completed' ELSE 'failed' END AS status,
          pages AS last_page_offset, CAST(1000 AS BIGINT) AS last_page_limit, created_at
        FROM (SELECT {_DAY} AS run_id, event_type AS entity, min(ts) AS created_at,
                     count(*) AS pages FROM events GROUP BY 1, 2)""",
    "v_source_counts": """
        SELECT run_id, CASE entity WHEN 'click' THEN 'contacts' WHEN 'view' THEN 'companies'
            WHEN 'purchase' THEN 'orders' WHEN 'signup' THEN 'users' WHEN 'error' THEN 'tasks' END
            AS entity, CAST(sum(item_count) AS BIGINT) AS items_retrieved
        FROM v_request_metrics GROUP BY 1, 2""",
    "v_snapshots": """
        SELECT run_id, entity AS table_name, count(*) AS row_count, 'crm' AS schema_name
        FROM v_request_metrics GROUP BY 1, 2""",
    "v_progress_events": """
        SELECT id AS seq, run_id, entity,
          CASE id % 5 WHEN 0 THEN 'running' WHEN 1 THEN 'running' WHEN 2 THEN 'completed'
               WHEN 3 THEN 'failed' ELSE 'pending' END AS status,
          CASE WHEN id % 3 != 0 THEN id // 10 END AS page_offset,
          CASE WHEN id % 4 != 0 THEN item_count END AS items_processed,
          error_message, created_at AS at_time
        FROM v_request_metrics""",
    "v_checkpoint_events": """
        SELECT id AS seq, run_id, entity,
          CASE id % 3 WHEN 0 THEN 'page' WHEN 1 THEN 'batch' ELSE 'entity' END AS checkpoint_type,
          '{"last_page":' || (id % 50) || ',"total_records":' || item_count || '}'
            AS checkpoint_data, created_at
        FROM v_request_metrics""",
}

_REFERENCE = re.compile(r"\bv_\w+")


def with_views(sql: str) -> str:
    """Prefix a query with the definitions of the views it uses, parents first."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in sorted(set(_REFERENCE.findall(text))):
            if name in VIEWS and name not in ordered:
                need(VIEWS[name])
                ordered.append(name)

    need(sql)
    if not ordered:
        return sql
    body = sql.strip()
    ctes = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in ordered)
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
