"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Comparison: same column names, same row count, same multiset of rows after
sorting columns by name (floats compared after rounding to 6 places).

    python tests/oracle_harness.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_conn(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _norm(x)) for k, x in v.asDict().items()))
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def _rows(cols: list[str], rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: repr(t))


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
    "float": "FLOAT", "array<string>": "VARCHAR[]", "smallint": "SMALLINT",
}


def type_mismatches(sdf, res) -> list[str]:
    """Columns whose Spark type does not map to the DuckDB result type."""
    duck = {d[0]: str(d[1]) for d in res.description}
    out = []
    for f in sdf.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        if f.name in duck and duck[f.name] != want:
            out.append(f"{f.name}: spark {f.dataType.simpleString()} vs duckdb {duck[f.name]}")
    return out


def compare(spark, sf_dir: str, name: str, con=None) -> tuple[bool, str]:
    from __spark_entry__ import oracle_sql, queries

    con = con or duckdb_conn(sf_dir)
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    sql = oracle_sql().get(name)
    if sql is None:
        return True, f"{name}: spark rows={len(s_rows)} (no oracle) {t1 - t0:.1f}s"
    res = con.execute(sql)
    types = type_mismatches(sdf, res)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"{name}: columns differ spark={s_cols} duckdb={d_cols}"
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if len(a) != len(b):
        return False, f"{name}: row count spark={len(a)} duckdb={len(b)}"
    if a != b:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"{name}: values differ ({len(a)} rows), e.g. {diffs}"
    if types:
        return False, f"{name}: types differ {types}"
    return True, f"{name}: OK rows={len(a)} spark {t1 - t0:.1f}s"


def main(argv: list[str]) -> int:
    from rawhouse.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8, driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    from __spark_entry__ import queries

    names = argv[2:] or list(queries())
    con = duckdb_conn(sf_dir)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, sf_dir, n, con)
        except Exception as e:  # report and continue
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
