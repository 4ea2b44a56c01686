"""Compare a registered Spark query with its DuckDB oracle SQL (our own copy of the
driver's check: row count, column names, order-insensitive values)."""

from __future__ import annotations

import datetime as _dt
import decimal
import math
from collections import Counter

import duckdb

from venuelens.standins import BASE_TABLES


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def duck_run(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def _norm(v, digits):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) if digits is not None else v
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x, digits)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(_norm(x, digits) for x in v)
    return v


def normalize(cols, rows, digits=None):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [c for c in sorted(cols)], Counter(tuple(_norm(r[i], digits) for i in order) for r in rows)


def compare(spark_cols, spark_rows, duck_cols, duck_rows):
    """Return (status, detail): status in exact / close / mismatch."""
    sc, sr = normalize(spark_cols, spark_rows)
    dc, dr = normalize(duck_cols, duck_rows)
    if sc != dc:
        return "mismatch", f"columns {sc} vs {dc}"
    if len(spark_rows) != len(duck_rows):
        return "mismatch", f"rows {len(spark_rows)} vs {len(duck_rows)}"
    if sr == dr:
        return "exact", ""
    _, sr6 = normalize(spark_cols, spark_rows, 6)
    _, dr6 = normalize(duck_cols, duck_rows, 6)
    if sr6 == dr6:
        return "close", "float last digits differ"
    diff = list((sr6 - dr6).elements())[:3]
    diff2 = list((dr6 - sr6).elements())[:3]
    return "mismatch", f"spark-only {diff} duck-only {diff2}"


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE", "float": "FLOAT",
                 "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE",
                 "timestamp_ntz": "TIMESTAMP", "binary": "BLOB"}


def spark_type(dt) -> str:
    """Spark data type in DuckDB spelling (for schema comparison)."""
    s = dt.simpleString()
    if s.startswith("decimal"):
        return s.upper()
    if s.startswith("array<"):
        return spark_type(dt.elementType) + "[]"
    if s.startswith("map<"):
        return f"MAP({spark_type(dt.keyType)}, {spark_type(dt.valueType)})"
    return SPARK_TO_DUCK.get(s, s)


def type_diff(spark_schema, con, sql: str) -> dict:
    st = {f.name: spark_type(f.dataType) for f in spark_schema.fields}
    rel = con.sql(sql)
    dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
