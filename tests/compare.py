"""Compare a Spark query with its SQL on the same parquet tables."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


_KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "timestamp_ntz", "TIMESTAMP WITH TIME ZONE": "timestamp", "FLOAT": "float",
}


def _value(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_value(x) for x in v)
    return v


def _rows(rows, order):
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql: str, limit: int = 4) -> list[str]:
    """Empty when names, types and rows agree."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: _KINDS.get(str(d[1]), str(d[1])) for d in cur.description}
    expected = cur.fetchall()
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for f in df.schema.fields:
        if f.dataType.simpleString() != kinds[f.name]:
            out.append(f"type of {f.name}: {f.dataType.simpleString()} != {kinds[f.name]}")
    got = df.collect()
    cols = sorted(names)
    a = _rows(got, [df.columns.index(c) for c in cols])
    b = _rows(expected, [names.index(c) for c in cols])
    if len(a) != len(b):
        out.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        sa, sb = set(map(repr, a)), set(map(repr, b))
        out.append(f"columns in order {cols}")
        out += [f"  spark only {r}" for r in sorted(sa - sb)[:limit]]
        out += [f"  sql only   {r}" for r in sorted(sb - sa)[:limit]]
    return out
