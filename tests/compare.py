"""Run registered queries against their SQL in DuckDB: python -m tests.compare DIR [name part ...]"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(path: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as from '{path}/{table}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows sorted."""
    df = df[sorted(df.columns)]
    out = {}
    for name, values in df.items():
        if pd.api.types.is_bool_dtype(values):
            out[name] = values.astype(object).map(lambda v: "~" if pd.isna(v) else str(bool(v)))
        elif pd.api.types.is_numeric_dtype(values):
            # Nine digits hide the order of floating-point sums, nothing else.
            out[name] = values.map(lambda v: "~" if pd.isna(v) else f"{float(v) + 0.0:.9g}")
        else:
            out[name] = values.map(lambda v: "~" if pd.isna(v) else str(v))
    out = pd.DataFrame(out, columns=sorted(df.columns)).astype(str)
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def differences(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} against {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} rows against {len(sql_rows)}"
    left, right = canonical(spark_rows), canonical(sql_rows)
    if left.equals(right):
        return None
    wrong = (left != right).any(axis=1)
    return f"{int(wrong.sum())} rows differ\n{left[wrong].head(3)}\n{right[wrong].head(3)}"


def main(path: str, parts: list[str]) -> int:
    import __spark_entry__ as entry
    from stormledger.session import build

    spark = build(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, checks, bad = connect(path), entry.oracle_sql(), 0
    for name, build_query in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            rows = build_query(spark, path).toPandas()
            took = time.time() - start
            note = "no check" if name not in checks else differences(rows, con.sql(checks[name]).df())
        except Exception as error:  # report and go on with the next query
            took, note, rows = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}", []
        bad += note not in (None, "no check")
        print(f"{'ok  ' if note is None else 'FAIL' if note != 'no check' else 'rows'} {took:6.2f}s {len(rows):>8} {name} {note or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
