"""Run registered queries on Spark and their SQL on DuckDB and compare the results."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
import sys
import time

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, (int, float)):
        return float(value) if isinstance(value, float) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows(records, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in records]
    return sorted(plain, key=repr)


def compare(spark_df, con, sql: str) -> str | None:
    """``None`` when equal, otherwise what differs."""
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    want_types = {d[0]: str(d[1]) for d in rel.description}
    want = rows(rel.fetchall(), cols)
    got_cols = spark_df.columns
    if sorted(got_cols) != sorted(cols):
        return f"columns {sorted(got_cols)} != {sorted(cols)}"
    got = rows([tuple(r) for r in spark_df.collect()], got_cols)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; first got {got[:2]} want {want[:2]}"
    for g, w in zip(got, want):
        if g != w:
            diff = [(c, a, b) for c, a, b in zip(sorted(cols), g, w) if a != b]
            return f"differs at {diff}"
    loose = {"LongType": "BIGINT", "IntegerType": "INTEGER", "StringType": "VARCHAR",
             "DoubleType": "DOUBLE", "BooleanType": "BOOLEAN"}
    for f in spark_df.schema.fields:
        kind = type(f.dataType).__name__
        have = want_types[f.name]
        if kind in loose and loose[kind] != have:
            return f"type of {f.name}: {kind} against {have}"
        if kind not in loose and not kind.startswith("Timestamp"):
            return f"type of {f.name}: {kind}"
    return None


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from clientele.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session()
    con = duck(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    wanted = [n for n in queries if not argv or any(n.startswith(a) for a in argv)]
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in sqls:
                problem = compare(df, con, sqls[name])
                n = df.count() if "-n" in argv else ""
            else:
                n = len(df.collect())
                problem = None if n else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        verdict = "ok" if problem is None else f"FAIL {problem}"
        mark = "" if name in sqls else " (rows only)"
        print(f"{name:32s} {time.time() - start:6.2f}s {verdict}{mark}", flush=True)
        bad += problem is not None
    print(f"{len(wanted)} queries, {bad} failed, {len(set(wanted) & set(sqls))} against SQL")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
