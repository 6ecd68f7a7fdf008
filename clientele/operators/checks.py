"""Referential and rule validation."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.functions.payload import blank
from clientele.operators.flatten import contact_emails
from clientele.plans.specs import ENTITIES, Entity, ForeignKey

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class OrphanCheck:
    """Foreign keys of one table; no columns means all of them."""

    entity: Entity
    columns: tuple[str, ...] = ()

    @property
    def references(self) -> list[ForeignKey]:
        keys = self.entity.foreign_keys
        return [r for r in keys if not self.columns or r.column in self.columns]


def _parent_keys(tables: Tables, parent: str) -> DataFrame:
    return tables[parent].select(F.col("id").alias("_parent")).distinct()


def lost_keys(tables: Tables, wanted: list[OrphanCheck]) -> DataFrame:
    """(child, fk, key, rows): every foreign key value without a parent and how often it is used.

    All references are checked in one shuffle. Each child table is read once and unfolded into
    its keys; keys and parent ids meet in one aggregate per (parent table, key), which counts the
    uses per reference and sees whether the parent is there. Partial counts are made before the
    shuffle, so a value that a third of the rows share crosses as one row per map task, and of
    the tables nothing but their distinct keys moves.
    """
    pairs = {(c.entity.name, r.column): r for c in wanted for r in c.references}
    parents = sorted({r.parent for r in pairs.values()})
    # References are numbered within their parent; -1 stands for the parent's own ids.
    slots = {p: [pair for pair, r in pairs.items() if r.parent == p] for p in parents}
    rows = [
        tables[p].select(
            F.lit(number).alias("parent"), F.lit(-1).alias("slot"), F.col("id").cast("bigint").alias("key")
        )
        for number, p in enumerate(parents)
    ]
    for child in sorted({c for c, _ in pairs}):
        uses = []
        for (owner, column), ref in pairs.items():
            if owner == child:
                slot = slots[ref.parent].index((owner, column))
                counts = F.lit(True) if ref.null_is_orphan else F.col(column).isNotNull()
                uses.append(
                    F.struct(
                        F.lit(parents.index(ref.parent)).alias("parent"), F.lit(slot).alias("slot"),
                        F.col(column).cast("bigint").alias("key"), counts.alias("counts"),
                    )
                )
        unfolded = tables[child].select(F.inline(F.array(*uses)))
        rows.append(unfolded.filter("counts").drop("counts"))
    widest = range(max(len(s) for s in slots.values()))
    met = union_all(rows).groupBy("parent", "key").agg(
        F.max(F.col("slot") == -1).alias("present"),
        *[F.count_if(F.col("slot") == i).alias(f"n{i}") for i in widest],
    )
    pieces = ", ".join(f"{i}, n{i}" for i in widest)
    lost = met.filter("NOT present").select(
        "parent", "key", F.expr(f"stack({len(widest)}, {pieces}) AS (slot, rows)")
    )
    names = F.array(
        *[
            F.array(*[F.struct(F.lit(c).alias("child"), F.lit(f).alias("fk")) for c, f in slots[p]])
            for p in parents
        ]
    )
    name = F.get(F.get(names, F.col("parent")), F.col("slot"))
    used = lost.filter("rows > 0")
    return used.select(name.getField("child").alias("child"), name.getField("fk").alias("fk"), "key", "rows")


def orphan_rows(tables: Tables, check: OrphanCheck, lost: DataFrame) -> DataFrame:
    """Child rows that use at least one of the ``lost`` keys.

    ``lost`` should be a stored table, whose size Catalyst knows: a short list of lost keys is
    then broadcast and the child rows stay where they are; a list above the broadcast threshold
    is joined by a shuffle, in which hot keys are split at run time.
    """
    child = tables[check.entity.name]
    hit = F.lit(False)
    for i, ref in enumerate(check.references):
        mine = (F.col("child") == check.entity.name) & (F.col("fk") == ref.column)
        keys = lost.filter(mine).select(
            F.col("key").alias(f"_key{i}"), F.lit(True).alias(f"_lost{i}")
        )
        same = F.col(ref.column) == F.col(f"_key{i}")
        if ref.null_is_orphan:
            same = F.col(ref.column).eqNullSafe(F.col(f"_key{i}"))
        child = child.join(keys, same, "left")
        hit = hit | F.coalesce(F.col(f"_lost{i}"), F.lit(False))
    return child.filter(hit).select(*tables[check.entity.name].columns)


def lost_flags(tables: Tables, child: str, references: list[ForeignKey]) -> DataFrame:
    """The distinct foreign-key tuples of a table with ``_n``, their rows, and per key ``_lost_<column>``.

    Rows are grouped by their keys first, so a tuple that a third of the rows share leaves each map
    task once. The tuples then meet the distinct ids of each parent; Catalyst broadcasts a parent
    that is small enough, and shuffles and splits hot keys otherwise.
    """
    columns = list(dict.fromkeys(r.column for r in references))
    tuples = tables[child].groupBy(*columns).agg(F.count("*").alias("_n"))
    for ref in references:
        parents = _parent_keys(tables, ref.parent)
        tuples = tuples.join(parents, F.col(ref.column) == F.col("_parent"), "left")
        gone = F.col("_parent").isNull()
        if not ref.null_is_orphan:
            gone = gone & F.col(ref.column).isNotNull()
        tuples = tuples.withColumn(f"_lost_{ref.column}", gone).drop("_parent")
    return tuples


def orphan_counts(tables: Tables, wanted: Mapping[str, OrphanCheck], label: str, name: str) -> DataFrame:
    """(label, count) per check: how many child rows have lost at least one parent.

    Nothing runs while the plan is built. All checks of a table share one grouping of its rows.
    """
    parts = []
    for child in dict.fromkeys(c.entity.name for c in wanted.values()):
        mine = {key: c for key, c in wanted.items() if c.entity.name == child}
        references = {r.column: r for c in mine.values() for r in c.references}
        flags = lost_flags(tables, child, list(references.values()))
        counts = []
        for check in mine.values():
            hit = F.lit(False)
            for ref in check.references:
                hit = hit | F.col(f"_lost_{ref.column}")
            counts.append(F.coalesce(F.sum(F.when(hit, F.col("_n"))), F.lit(0)).cast("bigint"))
        numbers = flags.agg(*[c.alias(f"_{i}") for i, c in enumerate(counts)])
        rows = [F.struct(F.lit(key).alias(label), F.col(f"_{i}").alias(name)) for i, key in enumerate(mine)]
        parts.append(numbers.select(F.inline(F.array(*rows))))
    return union_all(parts)


def orphan_count(tables: Tables, check: OrphanCheck, name: str = "orphans") -> DataFrame:
    """The count for one check, as one row."""
    return orphan_counts(tables, {"": check}, "_label", name).drop("_label")


def labelled(counts: DataFrame, label: str, column: str) -> DataFrame:
    return counts.select(F.lit(label).alias(column), *counts.columns)


def union_all(parts: list[DataFrame]) -> DataFrame:
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total


# The tables of the foreign-key report, in report order.
FK_REPORT: tuple[str, ...] = (
    "contact_tags", "contacts", "opportunities", "tasks", "notes", "orders", "order_items",
    "payments", "stages",
)


def fk_report(tables: Tables) -> DataFrame:
    wanted = {f"Orphaned {n}": OrphanCheck(ENTITIES[n]) for n in FK_REPORT}
    return orphan_counts(tables, wanted, "table_name", "orphan_count")


def orphan_note_samples(tables: Tables, limit: int = 10) -> DataFrame:
    """The first orphan notes by id, their bodies cut for display.

    Only ids are shuffled; the bodies of the ``limit`` chosen notes are fetched afterwards.
    """
    contacts = _parent_keys(tables, "contacts")
    ids = tables["notes"].select("id", "contact_id").filter("contact_id IS NOT NULL")
    lost = ids.join(contacts, F.col("contact_id") == F.col("_parent"), "left_anti")
    chosen = F.broadcast(lost.orderBy("id").limit(limit).select("id"))
    body = F.when(
        F.length("body") > 100, F.concat(F.substring("body", 1, 100), F.lit("..."))
    ).otherwise(F.col("body"))
    rows = tables["notes"].join(chosen, "id", "left_semi").orderBy("id")
    return rows.select("id", "contact_id", body.alias("body"), "created_at")


def one_row(counts: Mapping[str, DataFrame]) -> DataFrame:
    """Several one-number results side by side, as one row.

    The numbers are unioned and pivoted, which needs no join.
    """
    long = union_all(
        [df.select(F.lit(name).alias("_name"), F.col(df.columns[0]).alias("_n")) for name, df in counts.items()]
    )
    return long.agg(
        *[F.sum(F.when(F.col("_name") == name, F.col("_n"))).alias(name) for name in counts]
    )


def dashboard_checks(tables: Tables) -> DataFrame:
    return one_row(
        {
            "orphaned_notes": orphan_count(tables, OrphanCheck(ENTITIES["notes"], ("contact_id",))),
            "orphaned_tasks": orphan_count(tables, OrphanCheck(ENTITIES["tasks"], ("contact_id",))),
            "duplicate_emails": duplicate_exact_emails(tables["contacts"]),
        }
    )


# --- row rules -------------------------------------------------------------------------


def missing_company_name(companies: DataFrame) -> DataFrame:
    return companies.filter(blank("name")).select("id")


def missing_contact_names(contacts: DataFrame) -> DataFrame:
    return contacts.filter(blank("given_name") & blank("family_name")).select("id")


def json_shape_check(contacts: DataFrame) -> DataFrame:
    """Contacts whose payload has an address list but whose parsed list is null or empty."""
    listed = F.from_json("email_addresses", "array<string>")
    has_key = F.array_contains(F.json_object_keys("raw"), "email_addresses")
    return contacts.filter(has_key & (listed.isNull() | (F.size(listed) == 0))).select("id")


def stage_pipeline_mismatch(opportunities: DataFrame, stages: DataFrame) -> DataFrame:
    s = stages.select(
        F.col("id").alias("_stage"), F.col("pipeline_id").alias("stage_pipeline_id")
    )
    o = opportunities.select(
        F.col("id").alias("opportunity_id"), "stage_id", F.col("pipeline_id").alias("opp_pipeline_id")
    )
    joined = o.join(
        s,
        (F.col("stage_id") == F.col("_stage"))
        & (F.col("opp_pipeline_id") != F.col("stage_pipeline_id")),
    )
    return joined.select("opportunity_id", "opp_pipeline_id", "stage_pipeline_id")


def allowed_values_check(df: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """Rows whose value lies outside the enumeration; NULL passes, as in a CHECK rule."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))


# --- commerce rules --------------------------------------------------------------------


def order_reconciliation(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders whose total differs from the sum of their items by more than a cent.

    An order without items has no sum and does not count.
    """
    line = F.coalesce("subtotal", F.col("unit_price") * F.col("quantity"))
    sums = items.groupBy("order_id").agg(F.sum(line).alias("calc_subtotal"))
    diff = F.col("total") - F.col("calc_subtotal")
    return (
        orders.select("id", "total")
        .join(sums, F.col("id") == F.col("order_id"))
        .filter(F.abs(diff) > F.lit(0.01).cast("decimal(3,2)"))
        .select("id", "total", "calc_subtotal", diff.alias("diff"))
    )


def worst_reconciled(orders: DataFrame, items: DataFrame, limit: int = 100) -> DataFrame:
    found = order_reconciliation(orders, items)
    return found.orderBy(F.desc(F.abs("diff")), "id").limit(limit)


def overpaid_orders(orders: DataFrame, payments: DataFrame) -> DataFrame:
    paid = payments.groupBy("order_id").agg(F.sum("amount").alias("_paid"))
    joined = (
        orders.select("id", "total")
        .join(paid, F.col("id") == F.col("order_id"), "left")
        .withColumn("paid", F.coalesce("_paid", F.lit(0).cast("decimal(25,2)")))
    )
    over = F.col("paid") > F.col("total") + F.lit(0.01).cast("decimal(3,2)")
    return joined.filter(over).select("id", "total", "paid")


def most_overpaid(orders: DataFrame, payments: DataFrame, limit: int = 100) -> DataFrame:
    found = overpaid_orders(orders, payments)
    return found.orderBy(F.desc(F.col("paid") - F.col("total")), "id").limit(limit)


# --- duplicates ------------------------------------------------------------------------


def duplicate_email_groups(contacts: DataFrame) -> DataFrame:
    return (
        contact_emails(contacts)
        .groupBy("email")
        .agg(F.count("*").alias("dupes"))
        .filter("dupes > 1")
    )


def duplicate_exact_emails(contacts: DataFrame) -> DataFrame:
    groups = (
        contacts.filter("email IS NOT NULL").groupBy("email").agg(F.count("*").alias("_n"))
    )
    return groups.filter("_n > 1").agg(F.count("*").alias("duplicate_groups"))


# --- declared rules as data checks -----------------------------------------------------


def not_null_report(tables: Tables, entities: list[Entity]) -> DataFrame:
    """Rows that break a NOT NULL rule, per table and column; one pass over each table."""
    parts = []
    for entity in entities:
        if not entity.not_null:
            continue
        counts = tables[entity.name].agg(
            *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in entity.not_null]
        )
        pairs = ", ".join(f"'{c}', `{c}`" for c in entity.not_null)
        long = counts.select(
            F.expr(f"stack({len(entity.not_null)}, {pairs}) AS (column_name, null_rows)")
        )
        parts.append(labelled(long, entity.name, "table_name"))
    return union_all(parts)


def duplicate_keys(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    groups = df.groupBy(*key).agg(F.count("*").alias("_n")).filter("_n > 1")
    return groups.agg(F.count("*").alias("duplicate_groups"))


def key_uniqueness_report(tables: Tables, keys: Mapping[str, tuple[str, ...]]) -> DataFrame:
    return union_all(
        [labelled(duplicate_keys(tables[n], key), n, "table_name") for n, key in keys.items()]
    )


