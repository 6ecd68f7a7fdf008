"""Raw JSON records to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.functions.payload import field_column, iso_timestamp, parse_payload, unread_values
from clientele.plans.specs import Entity

_CORRUPT = "_corrupt"


def flatten(records: DataFrame, entity: Entity, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns of ``entity`` plus the payload itself; ``keep`` passes columns through."""
    parsed = parse_payload(records, entity.fields, _CORRUPT)
    return parsed.select(*keep, *[field_column(f) for f in entity.fields], "raw")


def with_reason(
    records: DataFrame, entity: Entity, keep: tuple[str, ...] = (), unread: bool = False
) -> DataFrame:
    """Typed rows with the ``reason`` a record is rejected for, NULL for a good one.

    A record is rejected if it is not a JSON object or lacks a key column; the rest load on. With
    ``unread`` a list of (field, text) stands beside every row: the values that became NULL because
    they do not fit their type.
    """
    parsed = parse_payload(records, entity.fields, _CORRUPT)
    # A value of an unexpected kind marks the record too; only unreadable JSON rejects it.
    no_object = F.try_parse_json("raw").isNull() | ~F.col("raw").rlike(r"^\s*\{")
    marked = F.col("_doc").getField(_CORRUPT).isNotNull()
    broken = F.col("_doc").isNull() | (marked & no_object)
    lost = [unread_values(entity.fields).alias("unread")] if unread else []
    typed = parsed.select(
        *keep, *[field_column(f) for f in entity.fields], "raw", *lost, broken.alias("_broken")
    )
    keyless = F.lit(False)
    for column in entity.key:
        keyless = keyless | F.col(column).isNull()
    reason = F.when(F.col("_broken"), "unparseable").when(keyless, "no key")
    return typed.withColumn("reason", reason).drop("_broken")


def good_rows(marked: DataFrame) -> DataFrame:
    return marked.filter("reason IS NULL").drop("reason", "unread")


def lost_values(marked: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """One row per value of a good row that its type could not hold; ``marked`` has ``unread``.

    Rows are chosen after the lists are opened: a filter before it would be pushed down to the
    records and parse them again for every field it looks at.
    """
    of_good = F.when(F.col("reason").isNull(), F.col("unread"))
    found = marked.select(*keep, F.explode_outer(of_good).alias("_lost")).filter("_lost IS NOT NULL")
    return found.select(*keep, "_lost.field", "_lost.text")


def rejected_rows(marked: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return marked.filter("reason IS NOT NULL").select(*keep, "raw", "reason")


def load_outcome(records: DataFrame, entity: Entity) -> DataFrame:
    """How many records load and how many are rejected, by reason."""
    marked = with_reason(records, entity)
    outcome = F.coalesce(F.concat(F.lit("rejected: "), "reason"), F.lit("loaded"))
    return marked.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("records"))


def parse_timestamps(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.withColumn(name, iso_timestamp(F.col(column)))


def reached_since(rows: DataFrame, since: str) -> Column:
    """Whether a row was created or modified at or after ``since``; an unparseable ``since`` keeps all.

    Of ``created_at`` and ``updated_at``, those count that the table has.
    """
    moment = iso_timestamp(F.lit(since))
    wanted = moment.isNull()
    for column in ("created_at", "updated_at"):
        if column in rows.columns:
            # Cast the constant, not the column, so that the comparison reaches the Parquet scan.
            wanted = wanted | (F.col(column) >= moment.cast(rows.schema[column].dataType))
    return wanted


def delta_since(rows: DataFrame, since: str) -> DataFrame:
    """Rows created or modified at or after ``since``; see ``reached_since``."""
    return rows.filter(reached_since(rows, since))


def tag_links(contacts: DataFrame) -> DataFrame:
    """Distinct (contact, tag) pairs from each contact's own tag list.

    Repeats are dropped inside the list, before the rows exist, so no shuffle is needed.
    """
    tags = F.array_distinct(F.from_json("tag_ids", "array<bigint>"))
    return contacts.select(F.col("id").alias("contact_id"), F.explode(tags).alias("tag_id")).filter(
        "tag_id IS NOT NULL"
    )


# Labels of an address list that count as a contact's own address.
EMAIL_LABELS: tuple[str, ...] = (
    "EMAIL1", "EMAIL", "PRIMARY", "Work", "work", "Other", "Primary",
)


def contact_emails(contacts: DataFrame) -> DataFrame:
    """(id, email) for every non-empty, lower-cased address under a known label."""
    listed = F.from_json("email_addresses", "array<struct<email:string,field:string>>")
    return (
        contacts.select("id", F.explode(listed).alias("e"))
        .filter(F.col("e.email").isNotNull() & (F.col("e.email") != ""))
        .filter(F.coalesce("e.field", F.lit("")).isin(*EMAIL_LABELS))
        .select("id", F.lower("e.email").alias("email"))
    )


def json_payload(table: DataFrame, name: str = "raw") -> DataFrame:
    """Add the whole row as JSON; timestamps become ISO strings, with microseconds unless 0."""
    formats = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss", "ignoreNullFields": "false"}
    formats["timestampFormat"] = "yyyy-MM-dd'T'HH:mm:ssXXX"

    def iso(field: T.StructField):
        col = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return col
        zone = "XXX" if isinstance(field.dataType, T.TimestampType) else ""
        whole = col == F.date_trunc("second", col)
        short, long = (F.date_format(col, f"yyyy-MM-dd'T'HH:mm:ss{part}{zone}") for part in ("", ".SSSSSS"))
        return F.when(whole, short).otherwise(long).alias(field.name)

    return table.withColumn(name, F.to_json(F.struct(*map(iso, table.schema.fields)), formats))
