"""Compare a registered query with its SQL twin in DuckDB: names, types, rows and values."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SPARK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "VARCHAR[]": "array<string>",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    return v


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(df, con, sql: str) -> list[str]:
    """Differences, empty when equal."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    kinds = {d[0]: str(d[1]) for d in rel.description}
    expected = rel.fetchall()
    got = [tuple(r) for r in df.collect()]
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if SPARK_TYPES.get(kinds[name], kinds[name]) != kind:
            problems.append(f"type of {name}: {kind} != {kinds[name]}")
    if len(got) != len(expected):
        problems.append(f"rows {len(got)} != {len(expected)}")
    a, b = canonical(got, df.columns), canonical(expected, names)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b, strict=False) if x != y]
        problems.append(f"{len(diff)} rows differ of {len(b)}; first {diff[:2]} ({sorted(names)})")
    if not expected:
        problems.append("oracle is empty")
    return problems


def main() -> int:
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from __spark_entry__ import oracle_sql, queries
    from stayledger.session import build_session

    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    only = sys.argv[1:]
    settings = {
        "spark.sql.shuffle.partitions": os.environ.get("CHECK_PARTITIONS", "8"),
        "spark.sql.session.timeZone": os.environ.get("CHECK_ZONE", "UTC"),
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
    }
    spark = build_session("oracle-check", "local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            problems = compare(df, con, oracles[name]) if name in oracles else []
            note = "" if name in oracles else f"(no oracle) rows={df.count()}"
        except Exception as exc:  # report and go on
            problems, note = [f"{type(exc).__name__}: {str(exc)[:600]}"], ""
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - t:.1f}s {note}", flush=True)
        for p in problems:
            print("     ", p[:900], flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
