"""Side-by-side check of a Spark query against its DuckDB oracle.

Compares the row count, the column names, the type family of each column and
an order-insensitive digest of the values (floats rounded to 9 significant
digits, times in ISO text).
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
from dataclasses import dataclass, field

from notchline.sources.tables import TABLES


def _family(type_name: str) -> str:
    t = type_name.lower()
    if any(s in t for s in ("char", "string", "text")):
        return "str"
    if "bool" in t:
        return "bool"
    if "timestamp" in t or t == "date":
        return "time"
    if any(s in t for s in ("double", "float", "real")):
        return "float"
    if "decimal" in t:
        return "decimal"
    if any(s in t for s in ("int", "long", "short", "byte")):
        return "int"
    if "binary" in t or "blob" in t:
        return "bytes"
    return t


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    return v


def _digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256()
    for k in keyed:
        h.update(k.encode())
    return h.hexdigest()


@dataclass
class Result:
    key: str
    spark_rows: int
    oracle_rows: int
    columns_match: bool
    types_match: bool
    values_match: bool
    detail: dict = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return (
            self.spark_rows == self.oracle_rows
            and self.columns_match
            and self.types_match
            and self.values_match
        )


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(key: str, spark_df, sql: str, con) -> Result:
    s_cols = spark_df.columns
    s_types = [f.dataType.simpleString() for f in spark_df.schema.fields]
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    o_cols = [d[0] for d in rel.description]
    o_rows = rel.fetchall()
    o_types = [str(d[1]) for d in rel.description]
    cols_ok = sorted(s_cols) == sorted(o_cols)
    s_fam = dict(zip(s_cols, map(_family, s_types)))
    o_fam = dict(zip(o_cols, map(_family, o_types)))
    types_ok = cols_ok and all(s_fam[c] == o_fam.get(c) for c in s_cols)
    vals_ok = cols_ok and _digest(s_cols, s_rows) == _digest(o_cols, o_rows)
    detail = {}
    if not (cols_ok and types_ok):
        detail["spark_schema"] = list(zip(s_cols, s_types))
        detail["oracle_schema"] = list(zip(o_cols, o_types))
    if cols_ok and not vals_ok:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_o = sorted(range(len(o_cols)), key=lambda i: o_cols[i])
        ss = {repr(tuple(_norm(r[i]) for i in order_s)) for r in s_rows}
        oo = {repr(tuple(_norm(r[i]) for i in order_o)) for r in o_rows}
        detail["only_spark"] = sorted(ss - oo)[:5]
        detail["only_oracle"] = sorted(oo - ss)[:5]
    return Result(key, len(s_rows), len(o_rows), cols_ok, types_ok, vals_ok, detail)
