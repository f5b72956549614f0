"""Run the registered queries against their oracle SQL: ``python -m verification.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .oracles import ORACLES
from .queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES.split():
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    text = pd.DataFrame({c: [_text(v) for v in frame[c]] for c in frame.columns})
    return text.sort_values(list(text.columns)).reset_index(drop=True) if len(text.columns) else text


def _text(value: object) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "NULL"
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, float):
        return repr(int(value)) if value.is_integer() else repr(value)
    return str(value)


def _types(table) -> dict[str, str]:
    return {f.name: str(f.type).removeprefix("large_") for f in table.schema}


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str] | int:
    """Differences in columns, types, row count or values; the row count when there are none."""
    ours, theirs = df.toArrow(), con.sql(sql).to_arrow_table()
    if (a := _types(ours)) != (b := _types(theirs)):
        return [f"columns {sorted(a.items() - b.items())} and {sorted(b.items() - a.items())}"]
    if len(ours) != len(theirs):
        return [f"{len(ours)} and {len(theirs)} rows"]
    a, b = _normal(ours.to_pandas()), _normal(theirs.to_pandas())
    unequal = a.ne(b).any(axis=1)
    return [f"{a[unequal].head(3).to_dict('records')} and {b[unequal].head(3).to_dict('records')}"] if unequal.any() else len(ours)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    for name in names:
        start = time.monotonic()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name not in ORACLES:
                result = f"rows only: {df.count()}"
            else:
                result = compare(df, con, ORACLES[name])
                result = f"equal, {result} rows" if isinstance(result, int) else f"DIFFERENT {result}"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            result = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:28s} {time.monotonic() - start:6.1f}s  {result}", flush=True)


if __name__ == "__main__":
    main()
