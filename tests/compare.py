"""Run queries against their SQL twins: python tests/compare.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _text(v) -> str:
    return f"{type(v).__name__}:{v!r}"


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a description of the first difference."""
    expected = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(expected.columns):
        left, right = set(df.columns), set(expected.columns)
        return f"columns: only spark {sorted(left - right)}, only sql {sorted(right - left)}"
    got = [tuple(_plain(r[n]) for n in names) for r in df.collect()]
    order = [expected.columns.index(n) for n in names]
    want = [tuple(_plain(r[i]) for i in order) for r in expected.fetchall()]
    if len(got) != len(want):
        return f"rows: spark {len(got)}, sql {len(want)}"
    got.sort(key=lambda t: [_text(v) for v in t])
    want.sort(key=lambda t: [_text(v) for v in t])
    bad = [(g, w) for g, w in zip(got, want) if g != w or [type(x) for x in g] != [type(x) for x in w]]
    if bad:
        g, w = bad[0]
        cells = [(n, a, b) for n, a, b in zip(names, g, w) if a != b or type(a) is not type(b)]
        return f"{len(bad)} of {len(got)} rows differ, first: {cells[:4]}"
    return None


def main() -> int:
    from ledgermill.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    con, failed = connect(sf_dir), 0
    for name in args or list(queries):
        started = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                result = compare(df, con, oracles[name])
                rows = con.sql(oracles[name]).shape[0]
            else:
                result, rows = None, df.count()
        except Exception as e:  # report and go on with the next query
            result, rows = f"{type(e).__name__}: {str(e)[:900]}", -1
        failed += result is not None
        kind = "sql" if name in oracles else "rows only"
        print(f"{'FAIL' if result else 'ok':4} {name} [{kind}] rows={rows} {time.time() - started:.1f}s {result or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
