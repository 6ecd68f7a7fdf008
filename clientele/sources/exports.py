"""Exports of single tables and of all tables, as CSV or Parquet."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.operators.contacts import contact_analytics, contacts_with_relationships
from clientele.plans.specs import JSON_SHAPES
from clientele.sources.tables import scan_entity
from clientele.sources.versions import drop_path

# Quotes are doubled, spaces kept, NULL and '' both written as nothing.
CSV_OPTIONS: dict[str, str] = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "emptyValue": "",
    "nullValue": "",
    "lineSep": "\n",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _csv_column(field: T.StructField) -> Column:
    """Lists of scalars joined by ``; ``, anything nested as JSON, the rest as it is."""
    column = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, T.ArrayType) and not isinstance(
        kind.elementType, (T.StructType, T.MapType, T.ArrayType)
    ):
        return F.array_join(column.cast("array<string>"), "; ").alias(field.name)
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(column).alias(field.name)
    return column


def csv_ready(df: DataFrame) -> DataFrame:
    return df.select(*[_csv_column(f) for f in df.schema.fields])


def _write(df: DataFrame, path: str, fmt: str) -> int:
    """Write and return the row count; an empty input leaves no file.

    Rows are counted while they are written, so a derived table is computed once.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    if fmt == "csv":
        counted.write.options(**CSV_OPTIONS).csv(path)
    else:
        counted.write.parquet(path)
    rows = seen.get["n"]
    if not rows:
        drop_path(df.sparkSession, path)
    return rows


def export_csv(df: DataFrame, path: str) -> int:
    return _write(csv_ready(df), path, "csv")


def read_csv_export(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.options(**CSV_OPTIONS, multiLine="true").schema(schema).csv(path)


def _found_type(shape: str | None) -> T.DataType | None:
    """The type that ``schema_of_variant_agg`` names; None if the column has no values of a known shape."""
    if shape is None or shape == "VOID":
        return None
    ddl = re.sub(r"\bOBJECT<>|\b(VOID|VARIANT)\b", "STRING", shape).replace("OBJECT<", "STRUCT<")
    return T.StructType.fromDDL(f"c {ddl}")["c"].dataType


def _widened(declared: T.DataType, found: T.DataType | None) -> T.DataType:
    """The declared type with the sub-keys that the data has beside the declared ones."""
    if isinstance(declared, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(_widened(declared.elementType, found.elementType))
    if isinstance(declared, T.StructType) and isinstance(found, T.StructType):
        known = {f.name: f for f in found.fields}
        fields = [T.StructField(f.name, _widened(f.dataType, known[f.name].dataType if f.name in known else None)) for f in declared.fields]
        return T.StructType(fields + [f for f in found.fields if f.name not in declared.names])
    if isinstance(declared, T.StringType) and isinstance(found, (T.StructType, T.ArrayType)):
        return found
    return declared


def json_shapes(df: DataFrame, shapes: Mapping[str, str] = JSON_SHAPES) -> dict[str, T.DataType]:
    """The type of every JSON text column: its declared shape with all further sub-keys its values have.

    One pass over the JSON columns, merged per task and then over tasks; a row per table reaches the driver.
    Without a single value of a column its declared shape stands.
    """
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    columns = [c for c in df.columns if c in text and c in shapes]
    if not columns:
        return {}
    found = df.agg(*[F.schema_of_variant_agg(F.try_parse_json(F.col(f"`{c}`"))).alias(c) for c in columns]).first()
    declared = {c: T.StructType.fromDDL(f"c {shapes[c]}")["c"].dataType for c in columns}
    return {c: _widened(declared[c], _found_type(found[c])) for c in columns}


def structured(df: DataFrame, shapes: Mapping[str, str] = JSON_SHAPES) -> DataFrame:
    """JSON text columns in structured form, with every sub-key that occurs in them."""
    kinds = json_shapes(df, shapes)
    return df.withColumns({c: F.from_json(c, kind) for c, kind in kinds.items()}) if kinds else df


def export_parquet(df: DataFrame, path: str, shapes: Mapping[str, str] = JSON_SHAPES) -> int:
    return _write(structured(df, shapes), path, "parquet")


_WRITERS: dict[str, Callable[[DataFrame, str], int]] = {
    "csv": export_csv,
    "parquet": export_parquet,
}


def _writer(fmt: str) -> Callable[[DataFrame, str], int]:
    if fmt not in _WRITERS:
        raise ValueError(f"unsupported format: {fmt}")
    return _WRITERS[fmt]


def export_entity(
    table: DataFrame, path: str, fmt: str = "csv", where: str | None = None, limit: int | None = None
) -> int:
    """One table, or the rows of it that a predicate picks; returns the row count."""
    order = "id" if "id" in table.columns else table.columns[0]
    return _writer(fmt)(scan_entity(table, where, limit, order), path)


def export_analytics(
    tables: Mapping[str, DataFrame], path: str, fmt: str = "parquet", limit: int | None = None
) -> int:
    """The contact dataset: child counts and values as Parquet, company and owner as CSV."""
    write = _writer(fmt)
    if fmt == "csv":
        rows, key = contacts_with_relationships(tables), "id"
    else:
        rows, key = contact_analytics(tables), "contact_id"
    return write(scan_entity(rows, None, limit, key), path)


def export_all(
    spark: SparkSession,
    tables: Mapping[str, Callable[[], DataFrame]],
    out: str,
    fmt: str = "csv",
    where: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Export every table in name order; one that fails does not stop the rest.

    Returns a manifest of (table_name, format, status, rows, detail).
    """
    _writer(fmt)
    manifest = []
    for name in sorted(tables):
        try:
            rows = export_entity(tables[name](), f"{out}/{name}", fmt, where, limit)
            manifest.append((name, fmt, "ok" if rows else "empty", rows, None))
        except Exception as error:  # the manifest reports it; the other tables go on
            manifest.append((name, fmt, "error", 0, str(error)))
    schema = "table_name string, format string, status string, rows bigint, detail string"
    return spark.createDataFrame(manifest, schema)
