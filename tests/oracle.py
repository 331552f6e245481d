"""Compare a Spark result with DuckDB's, order-insensitively, by column name."""

from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = Path(sf) / f"{table}.parquet"
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows(frame: pd.DataFrame) -> list[str]:
    def text(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "~"
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, float) and v == int(v):
            return repr(int(v))  # pandas turns integers with nulls into floats
        if isinstance(v, float):
            return repr(round(v, 9) + 0.0)
        if isinstance(v, int):
            return repr(v)
        return str(v)

    ordered = frame[sorted(frame.columns)]
    return sorted("|".join(map(text, r)) for r in ordered.astype(object).itertuples(index=False, name=None))


def compare(spark_frame, con, sql: str) -> tuple[int, list, list]:
    """Row count, and up to three rows only one side has (or has more often)."""
    got = spark_frame.toPandas()
    want = con.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns), (sorted(got.columns), sorted(want.columns))
    g, w = Counter(rows(got)), Counter(rows(want))
    return len(got), list(g - w)[:3], list(w - g)[:3]
