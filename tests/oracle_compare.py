"""Run a registered check in Spark and its SQL oracle in DuckDB on the same
parquet files and compare: row count, column names, and the multiset of
rows (order-insensitive, exact values)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "\x00NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v else "nan"
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (list, tuple)):
        return repr([_norm(x) for x in v])
    if isinstance(v, dict):
        return repr(sorted((str(k), _norm(x)) for k, x in v.items()))
    return repr(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), [names[i] for i in order]


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT"}


def duck_type(spark_type: str) -> str:
    return spark_type.upper().replace(" ", "") if spark_type.startswith("decimal") else SPARK_TO_DUCK.get(spark_type, spark_type.upper())


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    df = fn(spark, sf_dir)
    s_names = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    out = {"name": name, "spark_rows": len(s_rows)}
    if sql is None:
        out["ok"] = True
        out["mode"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    s_types = {f.name: duck_type(f.dataType.simpleString()) for f in df.schema.fields}
    d_types = {r[0]: r[1].replace(" ", "") for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out["types_ok"] = s_types == d_types
    if not out["types_ok"]:
        out["type_diff"] = {k: (s_types.get(k), d_types.get(k)) for k in set(s_types) | set(d_types) if s_types.get(k) != d_types.get(k)}
    res = con.execute(sql)
    d_names = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out["duck_rows"] = len(d_rows)
    sr, sn = rows_of(s_names, s_rows)
    dr, dn = rows_of(d_names, d_rows)
    out["names_ok"] = sn == dn
    out["ok"] = sn == dn and sr == dr and out["types_ok"]
    if not out["ok"]:
        out["spark_cols"] = sn
        out["duck_cols"] = dn
        ss, ds = set(sr), set(dr)
        out["only_spark"] = sorted(ss - ds)[:3]
        out["only_duck"] = sorted(ds - ss)[:3]
    return out
