"""Run registered queries in Spark and their SQL oracle in DuckDB; compare
row count, column names and an order-insensitive hash of the values.

CLI: python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time

import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute(f"SET TimeZone='{os.environ.get('ORACLE_TZ', 'UTC')}'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 9) + 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


_TYPES = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE",
          "StringType": "VARCHAR", "BooleanType": "BOOLEAN", "TimestampNTZType": "TIMESTAMP",
          "TimestampType": "TIMESTAMP WITH TIME ZONE", "DateType": "DATE", "FloatType": "FLOAT",
          "ShortType": "SMALLINT", "ByteType": "TINYINT", "BinaryType": "BLOB"}


def spark_type_name(dt) -> str:
    n = type(dt).__name__
    if n == "DecimalType":
        return f"DECIMAL({dt.precision},{dt.scale})"
    return _TYPES.get(n, dt.simpleString().upper())


def compare(spark, key: str, sf_dir: str, fn, sql: str, con=None, show: int = 3):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_types = {c[0]: str(c[1]) for c in res.description}
    s_types = {f.name: spark_type_name(f.dataType) for f in sdf.schema.fields}
    d_rows = res.fetchall()
    t2 = time.time()
    out = {"key": key, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_s": round(t1 - t0, 2), "oracle_s": round(t2 - t1, 2)}
    out["cols_match"] = sorted(s_cols) == sorted(d_cols)
    tdiff = {c: (s_types[c], d_types[c]) for c in s_types if c in d_types and s_types[c] != d_types[c]}
    out["types_match"] = not tdiff
    if tdiff:
        out["type_diff"] = tdiff
    if not out["cols_match"]:
        out["cols"] = (sorted(set(s_cols) - set(d_cols)), sorted(set(d_cols) - set(s_cols)))
        out["match"] = False
        return out
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    ha = hashlib.sha256("\n".join(a).encode()).hexdigest()
    hb = hashlib.sha256("\n".join(b).encode()).hexdigest()
    out["match"] = ha == hb
    if not out["match"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = [x for x in a if x not in sb][:show]
        out["only_oracle"] = [x for x in b if x not in sa][:show]
        out["cols_sorted"] = sorted(s_cols)
    return out


def main(argv):
    sys.path.insert(0, ".")
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    from tickforge.session import local_session
    spark = local_session(8)
    qs, os_ = E.queries(), E.oracle_sql()
    con = duck(sf)
    bad = 0
    for k in (keys or list(qs)):
        if k not in os_:
            t0 = time.time()
            n = qs[k](spark, sf).count()
            print({"key": k, "rows_only": n, "spark_s": round(time.time() - t0, 2)}, flush=True)
            continue
        try:
            r = compare(spark, k, sf, qs[k], os_[k], con)
        except Exception as e:  # report and go on
            r = {"key": k, "error": repr(e)[:800], "match": False}
        bad += not r["match"]
        print(r, flush=True)
    print("MISMATCHES", bad)


if __name__ == "__main__":
    main(sys.argv)
