"""Contact-level datasets and coverage counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.operators.checks import duplicate_email_groups, labelled, one_row, union_all
from clientele.operators.flatten import contact_emails

Tables = Mapping[str, DataFrame]

# Tables of the freshness report and whether they report a last update.
FRESHNESS: dict[str, bool] = {
    "users": True, "companies": False, "tags": False, "pipelines": False, "stages": False,
    "contacts": True, "contact_tags": False, "opportunities": True, "tasks": False,
    "notes": False, "products": False, "orders": False, "order_items": False, "payments": False,
}

# Entities of the dashboard counts.
COUNTED: tuple[str, ...] = (
    "contacts", "companies", "opportunities", "tasks", "notes", "tags", "users",
)


def contacts_with_relationships(tables: Tables) -> DataFrame:
    """Every contact with its company and owner.

    No broadcast is forced: Catalyst broadcasts a parent only if its size is under the
    threshold, and splits a company that owns a large share of the contacts otherwise.
    """
    company = tables["companies"].select(
        F.col("id").alias("_company"),
        F.col("name").alias("company_name"),
        F.col("website").alias("company_website"),
    )
    owner = tables["users"].select(
        F.col("id").alias("_owner"),
        F.col("email").alias("owner_email"),
        F.col("given_name").alias("owner_name"),
    )
    joined = (
        tables["contacts"]
        .join(company, F.col("company_id") == F.col("_company"), "left")
        .join(owner, F.col("owner_id") == F.col("_owner"), "left")
    )
    return joined.select(
        "id", "given_name", "family_name", "email", "phone", "address", "city", "state",
        "postal_code", "country_code", "email_status", "email_opted_in", "score_value",
        "company_name", "company_website", "owner_email", "owner_name",
        "created_at", "updated_at",
    )


def _children_per_contact(tables: Tables) -> DataFrame:
    """Counts of each kind of child per contact, in one shuffle.

    The children are stacked as (contact, kind) rows and counted together, so partial sums of
    all four tables cross a single exchange, and a contact that owns a third of them arrives as
    one row per map task.
    """

    def child(name: str, kind: str) -> DataFrame:
        value = F.col("value") if name == "opportunities" else F.lit(None)
        rows = tables[name].filter("tag_id IS NOT NULL") if name == "contact_tags" else tables[name]
        return rows.select(
            "contact_id", F.lit(kind).alias("kind"), value.cast("decimal(15,2)").alias("value")
        )

    rows = union_all(
        [
            child("opportunities", "opportunity"),
            child("tasks", "task"),
            child("notes", "note"),
            child("contact_tags", "tag"),
        ]
    )

    def number(kind: str):
        return F.count(F.when(F.col("kind") == kind, 1)).alias(f"{kind}_count")

    return (
        rows.filter("contact_id IS NOT NULL")
        .groupBy("contact_id")
        .agg(
            number("opportunity"), number("task"), number("note"), number("tag"),
            F.sum("value").alias("opportunity_value"),
        )
    )


def contact_analytics(tables: Tables, *, fanout: bool = False) -> DataFrame:
    """One row per contact with child counts and the value of its opportunities.

    ``fanout`` gives the sum a join of all four children would give, in which every value is
    repeated once per task, note and tag of the contact; a sum of 10^36 or more is NULL.
    """
    base = contacts_with_relationships(tables).select(
        F.col("id").alias("contact_id"), "given_name", "family_name", "email", "email_status",
        "email_opted_in", "score_value", "company_name", "company_website", "owner_email",
        "created_at", "updated_at",
    )
    children = _children_per_contact(tables).withColumnRenamed("contact_id", "_contact")
    counts = ["opportunity_count", "task_count", "note_count", "tag_count"]
    joined = base.join(children, F.col("contact_id") == F.col("_contact"), "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in counts}
    )
    value = F.col("opportunity_value")
    if fanout:
        for name in ("task_count", "note_count", "tag_count"):
            value = F.try_multiply(value, F.greatest(F.col(name), F.lit(1)).cast("decimal(19,0)"))
    return joined.select(
        "contact_id", "given_name", "family_name", "email", "email_status", "email_opted_in",
        "score_value", "company_name", "company_website", "owner_email", *counts,
        value.alias("total_opportunity_value"), "created_at", "updated_at",
    )


def random_sample(contacts: DataFrame, seed: str, size: int = 20) -> DataFrame:
    """A repeatable random choice: the contacts with the smallest seeded hashes."""
    return contacts.orderBy(F.md5(F.concat(F.col("id").cast("string"), F.lit(seed))), "id").limit(size)


def spot_check_counts(tables: Tables, seed: str, size: int = 20) -> DataFrame:
    """Child counts of a random sample of contacts.

    The sample is drawn first and has ``size`` rows, so it can be broadcast to the children;
    only their matching rows are counted.
    """
    sample = random_sample(tables["contacts"], seed, size).select("id", "given_name", "family_name")
    wanted = F.broadcast(sample.select(F.col("id").alias("contact_id")))
    result = sample
    for name, column in (("contact_tags", "tag_count"), ("opportunities", "opp_count"), ("tasks", "task_count")):
        per_contact = (
            tables[name]
            .select("contact_id")
            .join(wanted, "contact_id", "left_semi")
            .groupBy("contact_id")
            .agg(F.count("*").alias(column))
        )
        result = result.join(
            F.broadcast(per_contact), F.col("id") == F.col("contact_id"), "left"
        ).drop("contact_id")
        result = result.withColumn(column, F.coalesce(column, F.lit(0)))
    return result


# --- duplicates ------------------------------------------------------------------------


def duplicate_emails(contacts: DataFrame, limit: int = 100) -> DataFrame:
    """The most repeated addresses, one row per address and contact that lists it.

    ``dupes`` counts the group; ``times`` is how often the contact lists the address. The groups
    are found by counting alone, and only the top ``limit`` of them look up their contacts; no
    group is gathered in one task or one row.
    """
    emails = contact_emails(contacts)
    top = duplicate_email_groups(contacts).orderBy(F.desc("dupes"), "email").limit(limit)
    members = emails.join(top, "email")
    per_id = members.groupBy("email", "dupes", F.col("id").alias("contact_id"))
    return per_id.agg(F.count("*").alias("times"))


# --- coverage --------------------------------------------------------------------------


def freshness_counts(tables: Tables, dated: Mapping[str, bool] = FRESHNESS) -> DataFrame:
    parts = []
    for name, has_date in dated.items():
        latest = F.max("updated_at") if has_date else F.lit(None)
        counts = tables[name].agg(
            F.count("*").alias("n"), latest.cast("timestamp_ntz").alias("max_updated_at")
        )
        parts.append(labelled(counts, name, "tbl"))
    return union_all(parts)


def entity_counts(tables: Tables, names: tuple[str, ...] = COUNTED) -> DataFrame:
    return union_all(
        [labelled(tables[n].agg(F.count("*").alias("row_count")), n, "entity") for n in names]
    )


def coverage_totals(tables: Tables) -> DataFrame:
    names = {
        "contacts": "contacts", "tag_links": "contact_tags", "opportunities": "opportunities",
        "tasks": "tasks", "notes": "notes",
    }
    return one_row({label: tables[n].agg(F.count("*").alias("n")) for label, n in names.items()})


def coverage_distinct(tables: Tables) -> DataFrame:
    """Distinct contacts seen in three child tables; one shuffle of (table, contact) pairs."""
    names = {
        "contacts_with_tags": "contact_tags",
        "contacts_with_opps": "opportunities",
        "contacts_with_tasks": "tasks",
    }
    pairs = union_all(
        [tables[n].select(F.lit(label).alias("label"), "contact_id") for label, n in names.items()]
    )
    seen = pairs.filter("contact_id IS NOT NULL").distinct()
    return seen.agg(*[F.count(F.when(F.col("label") == x, 1)).alias(x) for x in names])
