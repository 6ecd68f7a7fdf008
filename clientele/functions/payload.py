"""Column helpers for JSON payloads."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.exact_json import mark_numbers, unmark_value
from clientele.plans.specs import JSON, TIME, Field

_PATH = re.compile(r"^(=?)(\w+)(\[0\])?(?:\.(\w+))?$")


def split_path(path: str) -> tuple[bool, str, bool, str | None]:
    """``'a[0].b'`` becomes (scalar only, top-level key, first of a list, key below)."""
    scalar, head, first, below = _PATH.match(path).groups()
    return scalar == "=", head, first is not None, below


def parse_payload(df: DataFrame, fields: Iterable[Field], corrupt: str) -> DataFrame:
    """Parse ``raw`` once, keeping every needed top-level value as text in ``_doc``.

    A nested value under ``key`` becomes ``_in_key``: a struct of the wanted sub-keys, or a list
    of such structs. It is part of the same parse, unless the whole value is needed as text too.
    Fractions are marked, see ``exact_json``, and unmarked in a projection of their own, once per
    path; ``path_value`` names its columns. All paths go through one lambda: a pattern per path makes
    a method too long to be compiled, which then runs interpreted, at several times the cost.
    """
    wanted = list(dict.fromkeys(p for f in fields for p in f.paths))
    paths = [split_path(p) for p in wanted]
    columns, nested = [], {}
    for head in sorted({head for _, head, _, _ in paths}):
        mine = [p for p in paths if p[1] == head]
        below = sorted({b for _, _, _, b in mine if b})
        shape = "string"
        if below:
            shape = "struct<" + ",".join(f"`{b}`:string" for b in below) + ">"
            shape = f"array<{shape}>" if any(first for _, _, first, _ in mine) else shape
            value = F.col("_doc").getField(head)
            as_text = any(b is None for _, _, _, b in mine)
            nested[f"_in_{head}"] = F.from_json(value, shape) if as_text else value
            shape = "string" if as_text else shape
        columns.append(f"`{head}` {shape}")
    schema = ", ".join([*columns, f"`{corrupt}` string"])
    parsed = df.withColumn(
        "_doc", F.from_json(mark_numbers(F.col("raw")), schema, {"columnNameOfCorruptRecord": corrupt})
    )
    parsed = parsed.withColumns(nested) if nested else parsed
    parsed = parsed.withColumn("_values", F.transform(F.array(*[_found(p) for p in wanted]), unmark_value))
    return parsed.withColumns({f"_at_{p}": F.col("_values").getItem(i) for i, p in enumerate(wanted)})


def _found(path: str) -> Column:
    """The marked text at ``path``; with a leading ``=`` only if it is neither an object nor a list."""
    scalar, head, first, below = split_path(path)
    if below:
        nested = F.col(f"_in_{head}")
        return (F.get(nested, F.lit(0)) if first else nested).getField(below)
    value = F.col("_doc").getField(head)
    return F.when(~value.rlike(r"^\s*[\{\[]"), value) if scalar else value


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text with ``Z`` or an offset; anything else is NULL.

    A bare time of day is refused: Spark would fill in today's date.
    """
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))


def path_value(path: str) -> Column:
    """The text at ``path`` in a frame made by ``parse_payload``."""
    return F.col(f"`_at_{path}`")


def field_column(field: Field) -> Column:
    """One typed column: the first path that has a value."""
    values = [path_value(p) for p in field.paths]
    if field.type == TIME:
        values = [iso_timestamp(v) for v in values]
    text = F.coalesce(*values) if len(values) > 1 else values[0]
    if field.type == JSON:
        value = F.coalesce(text, F.lit(field.default)) if field.default else text
    elif field.type in (TIME, "string"):
        value = text
    else:
        value = text.try_cast(field.type)
    return value.alias(field.name)


def unread_values(fields: Iterable[Field]) -> Column:
    """(field, text) of every value that is there and not blank but is lost by its type; in field order.

    ``field_column`` gives NULL for such a value. A money amount that would be rounded counts as read.
    """
    lost = []
    for field in fields:
        if field.type in (JSON, "string"):
            continue
        values = [path_value(p) for p in field.paths]
        text = F.coalesce(*values) if len(values) > 1 else values[0]
        gone = field_column(field).isNull() & (F.trim(text) != "")
        lost.append(F.when(gone, F.struct(F.lit(field.name).alias("field"), text.alias("text"))))
    if not lost:
        return F.array().cast("array<struct<field:string,text:string>>")
    return F.array_compact(F.array(*lost))


def blank(column: str) -> Column:
    """True for NULL and for the empty string."""
    return F.coalesce(F.col(column), F.lit("")) == ""
