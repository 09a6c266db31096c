"""Run a registered query on Spark and its oracle SQL on DuckDB, and compare.

The comparison is order-insensitive: columns are sorted by name, rows are
sorted, floats compared after rounding. Used by the tests and by hand:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _key(row):
    return tuple((x is None, "" if x is None else str(type(x)), x if x is not None else 0) for x in row)


def normalise(cols: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=_key)


# DuckDB type names as Spark simple strings, for the schema comparison.
_DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
               "BOOLEAN": "boolean", "DATE": "date", "FLOAT": "float", "SMALLINT": "smallint"}


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    dtypes = {r[0]: _DUCK_TYPES.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    scols, srows = normalise(sdf.columns, srows)
    dcols, drows = normalise(dcols, drows)
    return {
        "name": name, "spark_rows": len(srows), "oracle_rows": len(drows),
        "columns_match": scols == dcols, "values_match": srows == drows,
        "types_match": stypes == dtypes,
        "spark_sec": round(t1 - t0, 2),
        "first_diff": next(((a, b) for a, b in zip(srows, drows) if a != b), None),
        "spark_cols": scols, "oracle_cols": dcols,
    }


def main(argv: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from quern.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(entry.queries())
    spark = local_session(8, 8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, qs[n], sqls[n], sf_dir)
        except Exception as e:  # report and go on
            print(f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ok = r["columns_match"] and r["types_match"] and r["values_match"] and r["spark_rows"] == r["oracle_rows"]
        bad += not ok
        print(f"{n}: {'OK ' if ok else 'BAD'} rows {r['spark_rows']}/{r['oracle_rows']} "
              f"{r['spark_sec']}s" + ("" if ok else f" cols {r['spark_cols']} vs {r['oracle_cols']} "
                                                     f"diff {r['first_diff']}"))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
