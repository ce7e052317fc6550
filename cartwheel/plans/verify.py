"""Compare a Spark result with its DuckDB oracle: same columns (sorted by
name), same row count, same multiset of normalised rows."""

from __future__ import annotations

import datetime as _dt
import decimal
import math

from pyspark.sql import DataFrame

from cartwheel.sources.tables import TABLE_NAMES


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, int):
        return float(v)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return _dt.datetime(v.year, v.month, v.day).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(df: DataFrame, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck_connect(sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not res["columns_match"]:
        res["spark_cols"], res["oracle_cols"] = sorted(s_cols), sorted(d_cols)
        res["match"] = False
        return res
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    res["match"] = a == b
    if not res["match"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = [x for x in a if x not in sb][:3]
        res["only_oracle"] = [x for x in b if x not in sa][:3]
    return res
