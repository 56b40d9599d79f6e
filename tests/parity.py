"""Spark-vs-DuckDB parity check, mirroring the driver's gate: same row count,
same column names and types, same multiset of rows (columns compared by name, doubles
compared after rounding to 9 significant digits).

CLI: ``python -m tests.parity [--strict] [--plain] [--no-aqe] [--zone=Area/City] /root/testdata/sf0.01 [query ...]``
"""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


STRICT = False

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v if STRICT else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, sf_dir: str, name: str, query, sql: str | None, con=None):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = {"query": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck_connect(sf_dir)
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res["oracle_rows"] = len(drows)
    if sorted(scols) != sorted(dcols):
        res["status"] = f"COLUMNS differ: spark={sorted(scols)} oracle={sorted(dcols)}"
        return res
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema}
    dtypes = {d[0]: str(d[1]) for d in cur.description}
    mismatched = {c: (stypes[c], dtypes[c]) for c in stypes if stypes[c] != dtypes[c]}
    if mismatched:
        res["status"] = f"TYPES differ: {mismatched}"
        return res
    a, b = _rows(scols, srows), _rows(dcols, drows)
    if a == b:
        res["status"] = "match"
    else:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["status"] = "VALUES differ"
        res["sample"] = [str(d) for d in diff]
        only_s = set(a) - set(b)
        only_d = set(b) - set(a)
        res["only_spark"] = [str(x) for x in list(only_s)[:3]]
        res["only_oracle"] = [str(x) for x in list(only_d)[:3]]
    return res


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from gridlake.session import local_session

    global STRICT
    STRICT = "--strict" in argv
    plain = "--plain" in argv
    no_aqe = "--no-aqe" in argv
    zone = next((a.split("=", 1)[1] for a in argv if a.startswith("--zone=")), None)
    argv = [a for a in argv if a not in ("--plain", "--strict", "--no-aqe") and not a.startswith("--zone=")]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(E.queries())
    if plain:
        # the driver's own session: nothing of ours preset
        from pyspark.sql import SparkSession

        spark = (
            SparkSession.builder.master("local[*]")
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.ui.enabled", "false")
            .getOrCreate()
        )
    else:
        spark = local_session(8, 8)
    if zone:
        # results must not depend on the session zone
        spark.conf.set("spark.sql.session.timeZone", zone)
    if no_aqe:
        # nor on adaptive execution being available
        spark.conf.set("spark.sql.adaptive.enabled", "false")
    con = duck_connect(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, qs[n], oracle.get(n), con)
        except Exception as e:  # report and continue
            r = {"query": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    raise SystemExit(1 if main(sys.argv[1:]) else 0)
