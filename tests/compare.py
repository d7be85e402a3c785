"""Runs queries against their SQL: python -m tests.compare SF_DIR NAME_PREFIX..."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings strata stratum_constraints targets target_overview geography_assignment block_distribution forbes_top_tail aca_ptc_multipliers aca_ptc_lines eval_items".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f"{float(v):.9g}" if not isinstance(v, int) else str(v)
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return str(v)


def rows_of(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str, show: int = 3) -> list[str]:
    a_names, a = rows_of(df.columns, df.collect())
    res = con.execute(sql)
    b_names, b = rows_of([c[0] for c in res.description], res.fetchall())
    out = []
    if a_names != b_names:
        out.append(f"columns {a_names} and {b_names}")
    if len(a) != len(b):
        out.append(f"rows {len(a)} and {len(b)}")
    if a != b:
        in_a, in_b = set(a), set(b)
        only_a, only_b = [x for x in a if x not in in_b], [x for x in b if x not in in_a]
        out.append(f"only in Spark {only_a[:show]}, only in SQL {only_b[:show]}")
    return out


def main() -> None:
    import __spark_entry__ as e
    from weftline.session import local_session

    spark, con = local_session(), connect(sys.argv[1])
    qs, sql = e.queries(), e.oracle_sql()
    bad = 0
    for name in qs:
        if len(sys.argv) > 2 and not any(name.startswith(p) for p in sys.argv[2:]):
            continue
        t = time.time()
        try:
            df = qs[name](spark, sys.argv[1])
            diff = differences(df, con, sql[name]) if name in sql else []
            note = "ok" if name in sql else f"ran, {df.count()} rows"
        except Exception as x:  # noqa: BLE001
            diff, note = [f"{type(x).__name__}: {str(x)[:600]}"], ""
        bad += bool(diff)
        print(name, f"{time.time() - t:.1f}s", note if not diff else f"DIFFERS {diff}", flush=True)
    print("differing:", bad)


if __name__ == "__main__":
    main()
