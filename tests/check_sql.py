"""Run registered queries against their SQL: python tests/check_sql.py SF_DIR [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    rows = [
        tuple("\0" if pd.isna(v) else repr(v) if isinstance(v, float) else str(v) for v in row)
        for row in frame[columns].astype(object).itertuples(index=False)
    ]
    return sorted(rows)


def difference(spark, con, name: str, run, sql: str, sf_dir: str) -> str | None:
    """What differs between a query and its SQL, or None."""
    got_frame = run(spark, sf_dir)
    got, want = got_frame.toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    rel = con.sql(sql)
    kinds = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    for f in got_frame.schema.fields:
        if same.get(f.dataType.simpleString()) != kinds[f.name]:
            return f"type of {f.name}: {f.dataType.simpleString()} / {kinds[f.name]}"
    a, b = canonical(got), canonical(want)
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            bad = [(c, u[:300], v[:300]) for c, u, v in zip(sorted(got.columns), x, y) if u != v]
            return f"first difference {bad}; key {[u[:60] for u in x]}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from tests.conftest import session

    sf_dir, *names = sys.argv[1:]
    spark, con = session(), duck(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            if name in sql:
                problem = difference(spark, con, name, queries[name], sql[name], sf_dir)
                n = "checked"
            else:
                n, problem = f"{queries[name](spark, sf_dir).count()} rows, no SQL", None
        except Exception as e:
            n, problem = "", "FAILED " + str(e)[:1500]
        bad += problem is not None
        print(f"{name:24} {'ok' if problem is None else 'BAD'} {n} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
