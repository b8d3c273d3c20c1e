"""Run registered queries beside their SQL in DuckDB and tell where they differ."""

from __future__ import annotations

import math
import sys
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/*.parquet')" if path.is_dir() else f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return db


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return float(value) if value.__class__.__name__ == "Decimal" else value


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, name: str, function, sql: str, sf_dir: str, db) -> str:  # noqa: ANN001
    df = function(spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if ours == theirs:
        return ""
    only = [x for x in ours if x not in set(theirs)][:3], [x for x in theirs if x not in set(ours)][:3]
    return f"{len(ours)} and {len(theirs)} rows; only here {only[0]}, only in SQL {only[1]}"


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import time

    import __spark_entry__
    from kinloom.session import get_session

    sf = sys.argv[1]
    session = get_session("oracle", "local[2]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    connection = duck(sf)
    for key, fn in __spark_entry__.queries().items():
        if sys.argv[2:] and key not in sys.argv[2:] or (not sys.argv[2:] and key not in __import__("kinloom.plans.queries", fromlist=["x"]).QUERIES):
            continue
        began = time.time()
        try:
            told = difference(session, key, fn, __spark_entry__.oracle_sql()[key], sf, connection) if key in __spark_entry__.oracle_sql() else f"no SQL; {fn(session, sf).count()} rows"
        except Exception as e:  # noqa: BLE001
            told = f"ERROR {str(e)[:500]}"
        print(f"{key}: {told or 'equal'} ({time.time() - began:.1f} s)", flush=True)
