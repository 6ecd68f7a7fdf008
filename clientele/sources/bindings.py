"""The customer-relationship tables as views over the star-schema test tables.

Nothing is copied: every table is a projection or aggregate of the given Parquet files.
Some keys are pushed past their parent by a modulus, so that the checks have defects to find.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Which entity each event type stands for in the source counts.
EVENT_ENTITY: dict[str, str] = {
    "click": "contacts",
    "view": "companies",
    "purchase": "orders",
    "signup": "users",
    "error": "tasks",
}

# Schemas of the given tables; declared, so that no job is spent on reading footers.
STAR: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
        " p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
        " props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class CrmTables:
    """Lazily built DataFrames, by table name: ``CrmTables(spark, sf_dir)["contacts"]``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._built: dict[str, DataFrame] = {}

    def star(self, name: str) -> DataFrame:
        return self.spark.read.schema(STAR[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = _BUILDERS[name](self)
        return self._built[name]

    @staticmethod
    def names() -> list[str]:
        return sorted(_BUILDERS)


_BUILDERS: dict[str, Callable[[CrmTables], DataFrame]] = {}


def _table(name: str):
    def register(build: Callable[[CrmTables], DataFrame]):
        _BUILDERS[name] = build
        return build

    return register


# --- reference tables ------------------------------------------------------------------


@_table("users")
def _users(t: CrmTables) -> DataFrame:
    return t.star("supplier").selectExpr(
        "s_suppkey AS id",
        "s_name AS given_name",
        "concat('Nation ', s_nationkey) AS family_name",
        "concat('user', s_suppkey, '@staff.test') AS email",
        "TIMESTAMP_NTZ'2020-01-01' + make_dt_interval(CAST(s_suppkey % 1000 AS INT)) AS created_at",
        "TIMESTAMP_NTZ'2023-01-01' + make_dt_interval(CAST(s_suppkey % 60 AS INT)) AS updated_at",
    )


@_table("pipelines")
def _pipelines(t: CrmTables) -> DataFrame:
    return t.star("region").selectExpr("CAST(r_regionkey AS BIGINT) AS id", "r_name AS name")


@_table("stages")
def _stages(t: CrmTables) -> DataFrame:
    return t.star("nation").selectExpr(
        "CAST(n_nationkey AS BIGINT) AS id",
        "CAST(n_regionkey AS BIGINT) AS pipeline_id",
        "n_name AS name",
    )


@_table("tags")
def _tags(t: CrmTables) -> DataFrame:
    brands = t.star("part").select("p_brand").distinct()
    return brands.selectExpr("CAST(substring(p_brand, 7) AS BIGINT) AS id", "p_brand AS name")


@_table("companies")
def _companies(t: CrmTables) -> DataFrame:
    return t.star("nation").selectExpr(
        "CAST(n_nationkey AS BIGINT) AS id",
        "CASE n_nationkey WHEN 24 THEN '' WHEN 23 THEN NULL ELSE n_name END AS name",
        "concat('https://', lower(n_name), '.test') AS website",
    )


# --- contacts and their links ----------------------------------------------------------


@_table("contacts")
def _contacts(t: CrmTables) -> DataFrame:
    base = t.star("customer").selectExpr(
        "c_custkey AS id",
        "CAST(c_nationkey AS BIGINT) AS company_id",
        "CASE WHEN c_custkey % 50 = 7 THEN '' ELSE c_name END AS given_name",
        "CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE c_mktsegment END AS family_name",
        "concat(lower(c_mktsegment), c_custkey % 700, '@x.test') AS email",
        "concat('555-', lpad(c_custkey % 10000, 4, '0')) AS phone",
        "concat(c_custkey % 300, ' Main St') AS address",
        "concat('City ', c_custkey % 40) AS city",
        "concat('S', c_custkey % 12) AS state",
        "lpad(c_custkey % 100000, 5, '0') AS postal_code",
        "CASE WHEN c_custkey % 4 = 0 THEN 'CA' ELSE 'US' END AS country_code",
        "c_custkey % 103 AS owner_id",
        "CASE c_custkey % 3 WHEN 0 THEN 'SingleOptIn' WHEN 1 THEN 'NonMarketable' END AS email_status",
        "c_custkey % 2 = 0 AS email_opted_in",
        "CAST(c_acctbal AS DECIMAL(15,2)) AS score_value",
        "concat('[', 1 + c_custkey % 25, ',', 1 + c_custkey * 7 % 25, ',', 1 + c_custkey % 5, ']')"
        " AS tag_ids",
        "TIMESTAMP_NTZ'2023-01-01' + make_dt_interval(CAST(c_custkey % 365 AS INT)) AS created_at",
        "CASE WHEN c_custkey % 11 != 0 THEN TIMESTAMP_NTZ'2023-01-01'"
        " + make_dt_interval(CAST(c_custkey % 365 AS INT), CAST(c_custkey % 97 AS INT)) END"
        " AS updated_at",
    )
    emails = base.withColumn(
        "email_addresses",
        F.expr("""
            CASE WHEN id % 40 = 3 THEN '[]'
                 WHEN id % 40 = 5 THEN NULL
                 ELSE concat('[{"email":"', upper(email), '","field":"EMAIL1"}',
                             CASE WHEN id % 9 = 0 THEN concat(
                               ',{"email":"alt', id % 50, '@x.test","field":"Work"}',
                               ',{"email":"","field":"EMAIL"}',
                               ',{"email":"hidden', id, '@x.test","field":"HOME"}') ELSE '' END,
                             ']')
            END"""),
    )
    return emails.withColumn(
        "raw",
        F.expr("""
            concat('{"id":', id, ',"family_name":',
                   CASE WHEN family_name IS NULL THEN 'null' ELSE concat('"', family_name, '"') END,
                   CASE WHEN id % 80 = 45 THEN ',"email_addresses":null'
                        WHEN email_addresses IS NULL THEN ''
                        ELSE concat(',"email_addresses":', email_addresses) END,
                   ',"tag_ids":', tag_ids, '}')"""),
    )


@_table("contact_tags")
def _contact_tags(t: CrmTables) -> DataFrame:
    bought = (
        t.star("lineitem")
        .select("l_orderkey", "l_partkey")
        .join(t.star("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        .join(
            t.star("orders").select("o_orderkey", "o_custkey"),
            F.col("l_orderkey") == F.col("o_orderkey"),
        )
    )
    return bought.selectExpr(
        "o_custkey AS contact_id", "CAST(substring(p_brand, 7) AS BIGINT) AS tag_id"
    ).distinct()


@_table("opportunities")
def _opportunities(t: CrmTables) -> DataFrame:
    return t.star("orders").selectExpr(
        "o_orderkey AS id",
        "o_custkey AS contact_id",
        "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 26 END AS company_id",
        "concat('Deal ', o_orderkey) AS name",
        "o_orderkey % 27 AS stage_id",
        "o_orderkey % 6 AS pipeline_id",
        "CAST(o_totalprice AS DECIMAL(15,2)) AS value",
        "o_orderstatus AS status",
        "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 101 END AS owner_id",
        "o_orderdate AS created_at",
        "o_orderdate + make_dt_interval(CAST(o_orderkey % 30 AS INT)) AS updated_at",
    )


@_table("tasks")
def _tasks(t: CrmTables) -> DataFrame:
    return t.star("events").selectExpr(
        "event_id AS id",
        "user_id * 11 AS contact_id",
        "event_id * 2 AS opportunity_id",
        "CASE WHEN event_id % 4 = 0 THEN event_id % 107 END AS owner_id",
        "CASE WHEN event_id % 500 = 0 THEN NULL ELSE event_type END AS title",
        "props AS description",
        "ts AS due_date",
        "CASE WHEN event_id % 2 = 0 THEN ts + make_dt_interval(1) END AS completed_date",
        "ts AS created_at",
        "ts + make_dt_interval(0, CAST(event_id % 24 AS INT)) AS updated_at",
    )


@_table("notes")
def _notes(t: CrmTables) -> DataFrame:
    return t.star("conversations").selectExpr(
        "conv_id * 1000 + turn AS id",
        "conv_id * 20 AS contact_id",
        "CASE WHEN turn % 2 = 0 THEN conv_id END AS opportunity_id",
        "CASE WHEN turn = 0 THEN conv_id END AS owner_id",
        "role AS title",
        "text AS body",
        "TIMESTAMP_NTZ'2024-01-01'"
        " + make_dt_interval(0, CAST(conv_id AS INT), CAST(turn AS INT)) AS created_at",
    )


# --- commerce --------------------------------------------------------------------------


@_table("products")
def _products(t: CrmTables) -> DataFrame:
    return t.star("part").selectExpr(
        "p_partkey AS id",
        "p_name AS name",
        "p_type AS description",
        "CAST(p_retailprice AS DECIMAL(15,2)) AS price",
        "concat(p_brand, '/', p_size) AS sku",
        "p_size % 2 = 0 AS active",
    )


def _priced_lines(t: CrmTables) -> DataFrame:
    """Line items with whole-cent prices; integer arithmetic keeps the rounding exact."""
    return (
        t.star("lineitem")
        .select(
            "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_returnflag", "l_shipdate",
        )
        .withColumns(
            {
                "qty": F.expr("CAST(l_quantity AS BIGINT)"),
                "cents": F.expr("CAST(round(l_extendedprice * 100) AS BIGINT)"),
                "off": F.expr("CAST(round(l_discount * 100) AS BIGINT)"),
            }
        )
        .withColumn("unit_cents", F.expr("(2 * cents + qty) DIV (2 * qty)"))
    )


@_table("order_items")
def _order_items(t: CrmTables) -> DataFrame:
    return _priced_lines(t).selectExpr(
        "l_orderkey * 10 + l_linenumber AS id",
        "l_orderkey AS order_id",
        "l_partkey AS product_id",
        "concat('item ', l_partkey) AS name",
        "CAST(unit_cents * 0.01 AS DECIMAL(15,2)) AS unit_price",
        "CAST(qty AS DECIMAL(10,2)) AS quantity",
        "CASE WHEN l_linenumber % 2 = 1 THEN CAST(unit_cents * qty * 0.01 AS DECIMAL(15,2)) END"
        " AS subtotal",
    )


@_table("orders")
def _orders(t: CrmTables) -> DataFrame:
    item_cents = (
        _priced_lines(t)
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(F.expr("sum(unit_cents * qty)").alias("item_cents"))
    )
    joined = t.star("orders").join(
        item_cents, F.col("o_orderkey") == F.col("order_id"), "left"
    )
    return joined.selectExpr(
        "o_orderkey AS id",
        "o_custkey AS contact_id",
        "concat('ORD-', o_orderkey) AS order_number",
        "o_orderdate AS order_date",
        "CASE WHEN item_cents IS NULL THEN CAST(o_totalprice AS DECIMAL(15,2))"
        " ELSE CAST((item_cents + CASE WHEN o_orderkey % 10 = 0 THEN 500 ELSE 0 END) * 0.01"
        " AS DECIMAL(15,2)) END AS total",
        "o_orderstatus AS status",
        "o_orderdate AS created_at",
    )


@_table("payments")
def _payments(t: CrmTables) -> DataFrame:
    returned = _priced_lines(t).filter("l_returnflag = 'R'")
    return returned.selectExpr(
        "l_orderkey * 10 + l_linenumber AS id",
        "l_orderkey AS order_id",
        "CAST(((cents * (100 - off) + 50) DIV 100) * 0.01 AS DECIMAL(15,2)) AS amount",
        "l_shipdate AS payment_date",
        "'card' AS payment_method",
    )


# --- files -----------------------------------------------------------------------------


@_table("contact_files")
def _contact_files(t: CrmTables) -> DataFrame:
    return t.star("documents").selectExpr(
        "doc_id AS id",
        "n_chars % 200 AS contact_id",
        "concat('doc_', doc_id, '.txt') AS file_name",
        "concat('/store/', source, '/', doc_id) AS file_path",
        "n_chars * 1024 AS file_size",
        "CASE WHEN doc_id % 19 != 0 THEN lang END AS mime_type",
        "sha2(text, 256) AS file_hash",
        "concat('f', doc_id) AS remote_file_id",
        "TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, 0, CAST(doc_id AS INT)) AS created_at",
    )


# --- run metadata ----------------------------------------------------------------------

_RUN_STATUS = "CASE {0} % 3 WHEN 0 THEN 'running' WHEN 1 THEN 'success' ELSE 'error' END"


@_table("request_metrics")
def _request_metrics(t: CrmTables) -> DataFrame:
    events = t.star("events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("bigint")
    )
    return events.selectExpr(
        "event_id AS id",
        "CAST(dayofmonth(ts) AS BIGINT) AS run_id",
        "event_type AS entity",
        "concat('/v1/', event_type, '/', user_id % 3) AS endpoint",
        "CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS http_status",
        "k AS item_count",
        "CAST(floor(value * 10) AS BIGINT) AS duration_ms",
        "k * 2 AS throttle_remaining",
        "CASE WHEN k % 2 = 0 THEN 'minute' ELSE 'day' END AS throttle_type",
        "event_id % 3 AS retry_count",
        "CASE WHEN event_type = 'error' THEN concat('failure ', k % 7) END AS error_message",
        "ts AS created_at",
    )


@_table("request_log")
def _request_log(t: CrmTables) -> DataFrame:
    return t["request_metrics"].selectExpr(
        "id", "run_id", "endpoint", "http_status", "item_count", "duration_ms",
        "throttle_remaining < 100 AS throttled", "error_message AS error", "created_at",
    )


@_table("throttle_events")
def _throttle_events(t: CrmTables) -> DataFrame:
    low = t["request_metrics"].filter("throttle_remaining < 100")
    return low.selectExpr(
        "id", "run_id", "entity", "endpoint", "throttle_type", "throttle_remaining",
        "(100 - throttle_remaining) * 10 AS wait_time_ms", "created_at",
    )


@_table("error_events")
def _error_events(t: CrmTables) -> DataFrame:
    failed = t["request_metrics"].filter("error_message IS NOT NULL")
    return failed.selectExpr(
        "id", "run_id", "entity", "endpoint",
        "concat('http_', http_status + item_count % 4) AS error_type",
        "error_message", "retry_count", "created_at",
    )


@_table("system_health")
def _system_health(t: CrmTables) -> DataFrame:
    return t.star("events").selectExpr(
        "event_id AS id",
        "CAST(dayofmonth(ts) AS BIGINT) AS run_id",
        "concat(event_type, '_load') AS metric_name",
        "CAST(value AS DECIMAL(38,6)) AS metric_value",
        "'ms' AS metric_unit",
        "props AS tags",
        "ts AS recorded_at",
    )


@_table("run_log")
def _run_log(t: CrmTables) -> DataFrame:
    days = (
        t.star("events")
        .groupBy(F.expr("CAST(dayofmonth(ts) AS BIGINT)").alias("id"))
        .agg(F.min("ts").alias("started_at"), F.max("ts").alias("last_at"))
    )
    return days.selectExpr(
        "id",
        "started_at",
        "CASE WHEN id % 3 != 0 THEN last_at END AS finished_at",
        _RUN_STATUS.format("id") + " AS status",
        "concat('run ', id) AS notes",
    )


@_table("progress")
def _progress(t: CrmTables) -> DataFrame:
    loads = (
        t.star("events")
        .groupBy(F.expr("CAST(dayofmonth(ts) AS BIGINT)").alias("run_id"), F.col("event_type").alias("entity"))
        .agg(F.min("ts").alias("created_at"), F.count("*").alias("pages"))
    )
    return loads.selectExpr(
        "run_id",
        "entity",
        "CASE (run_id + length(entity)) % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'running'"
        " WHEN 2 THEN 'completed' ELSE 'failed' END AS status",
        "pages AS last_page_offset",
        "CAST(1000 AS BIGINT) AS last_page_limit",
        "created_at",
    )


@_table("source_counts")
def _source_counts(t: CrmTables) -> DataFrame:
    entity = F.create_map(*[F.lit(x) for pair in EVENT_ENTITY.items() for x in pair])
    return (
        t["request_metrics"]
        .withColumn("entity", entity[F.col("entity")])
        .groupBy("run_id", "entity")
        .agg(F.sum("item_count").alias("items_retrieved"))
    )


@_table("snapshots")
def _snapshots(t: CrmTables) -> DataFrame:
    return (
        t["request_metrics"]
        .groupBy("run_id", F.col("entity").alias("table_name"))
        .agg(F.count("*").alias("row_count"))
        .withColumn("schema_name", F.lit("crm"))
    )


# --- event streams folded by the merge operators ---------------------------------------


@_table("progress_events")
def _progress_events(t: CrmTables) -> DataFrame:
    return t["request_metrics"].selectExpr(
        "id AS seq",
        "run_id",
        "entity",
        "CASE id % 5 WHEN 0 THEN 'running' WHEN 1 THEN 'running' WHEN 2 THEN 'completed'"
        " WHEN 3 THEN 'failed' ELSE 'pending' END AS status",
        "CASE WHEN id % 3 != 0 THEN id DIV 10 END AS page_offset",
        "CASE WHEN id % 4 != 0 THEN item_count END AS items_processed",
        "error_message",
        "created_at AS at",
    )


@_table("checkpoint_events")
def _checkpoint_events(t: CrmTables) -> DataFrame:
    return t["request_metrics"].selectExpr(
        "id AS seq",
        "run_id",
        "entity",
        "CASE id % 3 WHEN 0 THEN 'page' WHEN 1 THEN 'batch' ELSE 'entity' END AS checkpoint_type",
        "concat('{\"last_page\":', id % 50, ',\"total_records\":', item_count, '}')"
        " AS checkpoint_data",
        "created_at",
    )


@_table("run_events")
def _run_events(t: CrmTables) -> DataFrame:
    """One start event per run and one end event per finished run."""
    runs = t["run_log"]
    starts = runs.selectExpr(
        "id AS run_id", "0 AS seq", "'start' AS kind", "started_at AS at",
        "CAST(NULL AS BOOLEAN) AS success", "notes",
    )
    ends = runs.filter("status != 'running'").selectExpr(
        "id AS run_id", "1 AS seq", "'end' AS kind", "finished_at AS at",
        "status = 'success' AS success", "concat('finished ', id) AS notes",
    )
    return starts.unionByName(ends)
