"""Spark-vs-DuckDB comparison used by the tests; ``python tests/verify.py [/sf/dir] [names]`` runs it alone.

Mirrors the driver's gate: row count, column names, and an order-insensitive
hash of the values (doubles rounded to 6 places, columns sorted by name).
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from recoloom.sources.tables import TABLES, table_path  # noqa: E402


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        r = round(v, 6)
        return repr(0.0 if r == 0 else r)
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, int):
        return str(v)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def table_digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [cols[i] for i in order], len(lines), h, lines


SPARK_TO_DUCK = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
                 "BooleanType": "BOOLEAN", "TimestampNTZType": "TIMESTAMP", "DateType": "DATE",
                 "FloatType": "FLOAT", "ShortType": "SMALLINT", "ByteType": "TINYINT"}


def type_mismatches(sdf, con, sql: str) -> dict:
    """Columns whose Spark type does not map to the DuckDB oracle's type."""
    st = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, f.dataType.simpleString()) for f in sdf.schema.fields}
    rel = con.sql(sql)
    dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}


def compare(spark, name: str, sf_dir: str, con=None, show: int = 5) -> dict:
    from recoloom.plans import ORACLES, QUERIES
    con = con or duck_connect(sf_dir)
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.execute(ORACLES[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    t2 = time.time()
    sc, sn, sh, sl = table_digest(sdf.columns, srows)
    dc, dn, dh, dl = table_digest(dcols, drows)
    res = {"name": name, "cols": sc == dc, "rows": (sn, dn), "hash": sh == dh,
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    bad_types = type_mismatches(sdf, con, ORACLES[name])
    res["types"] = not bad_types
    if bad_types:
        res["type_diff"] = bad_types
    if sc != dc:
        res["col_diff"] = (sc, dc)
    elif sh != dh and show:
        a, b = set(sl), set(dl)
        res["only_spark"] = sorted(a - b)[:show]
        res["only_duck"] = sorted(b - a)[:show]
    return res


def main(argv):
    from recoloom.plans import ORACLES
    from recoloom.session import local_session
    sf_dir = "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")] or sorted(ORACLES)
    for a in argv:
        if a.startswith("/"):
            sf_dir = a
    spark = local_session(8, 8)
    con = duck_connect(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": n, "error": (getattr(e, "getMessage", lambda: None)() or repr(e))[:400]}
        ok = r.get("cols") and r.get("hash") and r.get("types") and r["rows"][0] == r["rows"][1]
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} match")


if __name__ == "__main__":
    main(sys.argv[1:])
