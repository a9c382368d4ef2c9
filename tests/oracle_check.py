"""Compare every query with its SQL: ``python tests/oracle_check.py SF_DIR [key ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(value) -> tuple:
    return (value is not None, str(type(value)), value) if value is not None else (False, "", 0)


def _rows(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: [_key(v) for v in r])


def differences(spark, con, sf_dir: str, run, sql: str) -> list[str]:
    df = run(spark, sf_dir)
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    theirs = _rows(names, cur.fetchall())
    problems = []
    if sorted(df.columns) != sorted(names):
        problems.append(f"columns {sorted(df.columns)} vs {sorted(names)}")
    if len(mine) != len(theirs):
        problems.append(f"rows {len(mine)} vs {len(theirs)}")
    elif not problems:
        wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
        if wrong:
            problems.append(f"{len(wrong)} rows differ, first {wrong[0]}")
        kinds = {(type(x), type(y)) for a, b in zip(mine, theirs) for x, y in zip(a, b)}
        odd = [k for k in kinds if k[0] is not k[1] and type(None) not in k]
        if odd:
            problems.append(f"types {odd}")
    return problems


def main() -> None:
    import __spark_entry__ as entry
    from riskloom.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session(), connect(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sql:
                problems = differences(spark, con, sf_dir, run, sql[name])
                verdict = "ok" if not problems else "; ".join(problems)
            else:
                problems, verdict = [], f"{run(spark, sf_dir).count()} rows (no SQL)"
        except Exception as error:  # report and go on with the next query
            problems, verdict = [error], f"ERROR {str(error)[:600]}"
        bad += bool(problems)
        print(f"{name:22s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
