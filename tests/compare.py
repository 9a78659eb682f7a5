"""Run every registered query next to its SQL twin: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def connect(sf_dir: str):
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def tidy(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if str(frame[c].dtype).startswith("datetime"):
            frame[c] = frame[c].astype("datetime64[us]")
        elif frame[c].dtype.kind == "f":
            frame[c] = frame[c].astype(float) + 0.0
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str:
    """Empty when both hold the same rows."""
    a, b = tidy(spark_frame), tidy(sql_frame)
    if list(a.columns) != list(b.columns):
        return f"columns {list(a.columns)} != {list(b.columns)}"
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = same.idxmin()
            return f"{c}: {int((~same).sum())} rows differ, e.g. {a[c][i]!r} != {b[c][i]!r}"
        kinds = {k.replace("uint", "int") for k in (a[c].dtype.name, b[c].dtype.name)}
        if len(kinds) > 1:
            return f"{c}: type {a[c].dtype} != {b[c].dtype}"
    return ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries

    from orbitlens.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in wanted:
        try:
            t0 = time.time()
            got = queries()[name](spark, sf_dir).toPandas()
            t1 = time.time()
            sql = oracle_sql().get(name)
            note = difference(got, con.execute(sql).df()) if sql else "rows only"
            t2 = time.time()
        except Exception as e:  # report and go on with the next query
            note, t1, t2, got = f"ERROR {type(e).__name__}: {str(e)[:600]}", t0, t0, []
        bad += bool(note) and note != "rows only"
        print(f"{name:28s} {len(got):7d} rows  spark {t1 - t0:6.2f}s  sql {t2 - t1:6.2f}s  {note or 'ok'}", flush=True)
    print(f"{bad} of {len(wanted)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
