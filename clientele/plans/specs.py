"""What each entity looks like: columns, where they sit in the payload, keys and rules.

One table of specs drives flattening, merging, validation and comparison.
"""

from __future__ import annotations

from dataclasses import dataclass

MONEY = "decimal(15,2)"
QUANTITY = "decimal(10,2)"
ID = "bigint"
TEXT = "string"
TIME = "timestamp"
FLAG = "boolean"
JSON = "json"  # kept as JSON text; see JsonShape for the structured form


@dataclass(frozen=True)
class Field:
    """A column and the payload paths that may hold it; the first non-null one wins.

    A path is ``key``, ``key.sub`` or ``key[0].sub``. A leading ``=`` takes the value only if
    it is a plain scalar, for keys that hold a scalar in some records and an object in others.
    """

    name: str
    type: str
    paths: tuple[str, ...]
    default: str | None = None


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    null_is_orphan: bool = False


@dataclass(frozen=True)
class Entity:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ("id",)
    foreign_keys: tuple[ForeignKey, ...] = ()
    not_null: tuple[str, ...] = ()
    compare: tuple[str, ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields)

    @property
    def json_columns(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields if f.type == JSON)


def _f(name: str, type_: str = TEXT, *paths: str, default: str | None = None) -> Field:
    return Field(name, type_, paths or (name,), default)


_ID = _f("id", ID)
_CREATED = _f("created_at", TIME, "date_created")
_UPDATED = _f("updated_at", TIME, "date_modified", "last_updated")
_CUSTOM = _f("custom_fields", JSON, default="{}")
_OWNER = _f("owner_id", ID, "owner_id", "user_id", "user.id")
_CONTACT = _f("contact_id", ID, "contact_id", "contact.id")

USERS = Entity(
    "users",
    (
        _ID,
        _f("given_name"),
        _f("family_name"),
        _f("email", TEXT, "email_address"),
        _CREATED,
        _f("updated_at", TIME, "last_updated", "date_modified"),
    ),
    compare=("id", "given_name", "family_name", "email", "created_at", "updated_at"),
)

PIPELINES = Entity("pipelines", (_ID, _f("name"), _CREATED, _UPDATED), not_null=("name",))

STAGES = Entity(
    "stages",
    (_ID, _f("name"), _f("pipeline_id", ID), _CREATED, _UPDATED),
    foreign_keys=(ForeignKey("pipeline_id", "pipelines"),),
    not_null=("name",),
)

TAGS = Entity(
    "tags",
    (_ID, _f("name"), _f("description"), _CREATED, _UPDATED),
    not_null=("name",),
    compare=("id", "name", "description", "created_at", "updated_at"),
)

COMPANIES = Entity(
    "companies",
    (
        _ID,
        _f("name", TEXT, "company_name"),
        _f("website"),
        _f("phone", TEXT, "phone_number.number", "=phone_number"),
        _f("address", TEXT, "address.line1"),
        _f("city", TEXT, "address.locality"),
        _f("state", TEXT, "address.region"),
        _f("postal_code", TEXT, "address.postal_code", "address.zip_code"),
        _f("country_code", TEXT, "address.country_code"),
        _f("phone_numbers", JSON, default="[]"),
        _f("addresses", JSON, default="[]"),
        _CUSTOM,
        _CREATED,
        _UPDATED,
    ),
    not_null=("name",),
    compare=(
        "id", "name", "phone", "address", "city", "state", "postal_code", "country_code",
        "created_at", "updated_at",
    ),
)

CONTACTS = Entity(
    "contacts",
    (
        _ID,
        _f("company_id", ID, "company.id", "company_id"),
        _f("given_name"),
        _f("family_name"),
        _f("email", TEXT, "email_addresses[0].email"),
        _f("phone", TEXT, "phone_numbers[0].number"),
        _f("address", TEXT, "addresses[0].line1"),
        _f("city", TEXT, "addresses[0].locality"),
        _f("state", TEXT, "addresses[0].region"),
        _f("postal_code", TEXT, "addresses[0].postal_code", "addresses[0].zip_code"),
        _f("country_code", TEXT, "addresses[0].country_code"),
        _f("owner_id", ID),
        _f("middle_name"),
        _f("email_status"),
        _f("email_opted_in", FLAG),
        _f("score_value", "decimal(38,6)", "ScoreValue"),
        _f("tag_ids", JSON, default="[]"),
        _f("email_addresses", JSON, default="[]"),
        _f("phone_numbers", JSON, default="[]"),
        _f("addresses", JSON, default="[]"),
        _CREATED,
        _f("updated_at", TIME, "last_updated", "date_modified"),
    ),
    foreign_keys=(ForeignKey("company_id", "companies"), ForeignKey("owner_id", "users")),
    compare=(
        "id", "given_name", "family_name", "email", "phone", "address", "city", "state",
        "postal_code", "country_code", "owner_id", "created_at", "updated_at",
    ),
)

CONTACT_TAGS = Entity(
    "contact_tags",
    (_f("contact_id", ID), _f("tag_id", ID), _CREATED),
    key=("contact_id", "tag_id"),
    foreign_keys=(
        ForeignKey("contact_id", "contacts", null_is_orphan=True),
        ForeignKey("tag_id", "tags", null_is_orphan=True),
    ),
)

OPPORTUNITIES = Entity(
    "opportunities",
    (
        _ID,
        _CONTACT,
        _f("company_id", ID, "company_id", "company.id"),
        _f("name", TEXT, "name", "opportunity_title"),
        _f("description", TEXT, "description", "opportunity_notes"),
        _f("stage_id", ID, "stage_id", "stage.id"),
        _f("pipeline_id", ID, "pipeline_id", "pipeline.id"),
        _f("value", MONEY, "value", "projected_revenue_high"),
        _f("currency"),
        _f("status"),
        _OWNER,
        _CUSTOM,
        _f("stage_moves", JSON, default="[]"),
        _f("notes", JSON, default="[]"),
        _CREATED,
        _UPDATED,
    ),
    foreign_keys=(
        ForeignKey("contact_id", "contacts"),
        ForeignKey("company_id", "companies"),
        ForeignKey("owner_id", "users"),
        ForeignKey("pipeline_id", "pipelines"),
        ForeignKey("stage_id", "stages"),
    ),
    compare=(
        "id", "name", "contact_id", "stage_id", "pipeline_id", "owner_id",
        "created_at", "updated_at",
    ),
)

TASKS = Entity(
    "tasks",
    (
        _ID,
        _CONTACT,
        _f("company_id", ID),
        _f("opportunity_id", ID),
        _f("title"),
        _f("description"),
        _f("type"),
        _f("priority"),
        _f("status"),
        _f("due_date", TIME),
        _f("completed_date", TIME, "completed_date", "completion_date"),
        _OWNER,
        _CUSTOM,
        _f("reminder_time", TIME, "reminder_time", "remind_time"),
        _f("created_at", TIME, "date_created", "creation_date"),
        _f("updated_at", TIME, "date_modified", "modification_date", "last_updated"),
    ),
    foreign_keys=(
        ForeignKey("contact_id", "contacts"),
        ForeignKey("opportunity_id", "opportunities"),
        ForeignKey("owner_id", "users"),
    ),
    not_null=("title",),
    compare=(
        "id", "title", "contact_id", "owner_id", "completed_date", "created_at", "updated_at",
    ),
)

NOTES = Entity(
    "notes",
    (
        _ID,
        _CONTACT,
        _f("company_id", ID),
        _f("opportunity_id", ID),
        _f("title"),
        _f("body"),
        _f("note_type", TEXT, "type"),
        _OWNER,
        _CUSTOM,
        _CREATED,
        _UPDATED,
    ),
    foreign_keys=(
        ForeignKey("contact_id", "contacts"),
        ForeignKey("opportunity_id", "opportunities"),
        ForeignKey("owner_id", "users"),
    ),
    compare=("id", "body", "contact_id", "owner_id", "created_at", "updated_at"),
)

PRODUCTS = Entity(
    "products",
    (
        _ID,
        _f("name"),
        _f("description"),
        _f("price", MONEY),
        _f("currency"),
        _f("sku"),
        _f("status"),
        _f("active", FLAG),
        _CUSTOM,
        _f("product_family"),
        _f("subscription_plan_id", ID),
        _CREATED,
        _UPDATED,
    ),
    not_null=("name",),
)

ORDERS = Entity(
    "orders",
    (
        _ID,
        _CONTACT,
        _f("company_id", ID),
        _f("order_number"),
        _f("order_date", TIME),
        _f("total", MONEY),
        _f("currency"),
        _f("status"),
        _f("order_status", TEXT, "order_status", "status"),
        _f("payment_status"),
        _f("shipping_address", JSON),
        _f("billing_address", JSON),
        _CUSTOM,
        _CREATED,
        _UPDATED,
    ),
    foreign_keys=(ForeignKey("contact_id", "contacts"),),
)

ORDER_ITEMS = Entity(
    "order_items",
    (
        _ID,
        _f("order_id", ID),
        _f("product_id", ID),
        _f("name"),
        _f("description"),
        _f("unit_price", MONEY, "unit_price", "price"),
        _f("quantity", QUANTITY),
        _f("subtotal", MONEY, "subtotal", "total"),
        _CREATED,
        _UPDATED,
    ),
    foreign_keys=(ForeignKey("order_id", "orders"), ForeignKey("product_id", "products")),
    not_null=("name",),
)

PAYMENTS = Entity(
    "payments",
    (
        _ID,
        _f("order_id", ID),
        _f("amount", MONEY),
        _f("currency"),
        _f("payment_date", TIME),
        _f("payment_method"),
        _f("transaction_id"),
        _f("status"),
        _CREATED,
        _UPDATED,
    ),
    foreign_keys=(ForeignKey("order_id", "orders"),),
    not_null=("amount",),
)

# Parents come before children; every load runs in this order.
LOAD_ORDER: tuple[Entity, ...] = (
    USERS, PIPELINES, STAGES, TAGS, COMPANIES, CONTACTS, CONTACT_TAGS,
    OPPORTUNITIES, TASKS, NOTES, PRODUCTS, ORDERS, ORDER_ITEMS, PAYMENTS,
)

ENTITIES: dict[str, Entity] = {e.name: e for e in LOAD_ORDER}

# Keys and enumerations of the run-metadata and file tables.
META_KEYS: dict[str, tuple[str, ...]] = {
    "run_log": ("id",),
    "source_counts": ("run_id", "entity"),
    "snapshots": ("run_id", "schema_name", "table_name"),
    "progress": ("run_id", "entity"),
    "checkpoints": ("run_id", "entity", "checkpoint_type"),
    "contact_files": ("contact_id", "file_hash"),
}

# Fixed values.
ALLOWED_VALUES: dict[tuple[str, str], tuple[str, ...]] = {
    ("run_log", "status"): ("running", "success", "error"),
    ("progress", "status"): ("pending", "running", "completed", "failed"),
    ("checkpoints", "checkpoint_type"): ("page", "batch", "entity"),
}

# The envelope keys of a landed page, in the order they are tried.
ENVELOPE_KEYS: tuple[str, ...] = (
    "contacts", "users", "tags", "companies", "opportunities", "tasks", "notes",
    "products", "orders", "items", "data", "results",
)

# Structured form of the JSON text columns in a Parquet export.
JSON_SHAPES: dict[str, str] = {
    "tag_ids": "array<bigint>",
    "email_addresses": "array<struct<email:string,field:string>>",
    "phone_numbers": "array<struct<number:string,type:string>>",
    "addresses": (
        "array<struct<line1:string,line2:string,locality:string,region:string,"
        "postal_code:string,zip_code:string,country_code:string>>"
    ),
    "custom_fields": "map<string,string>",
    "stage_moves": "array<map<string,string>>",
    "notes": "array<map<string,string>>",
    "shipping_address": "map<string,string>",
    "billing_address": "map<string,string>",
}
