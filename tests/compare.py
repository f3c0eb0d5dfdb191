"""Run registered queries next to their comparison SQL in DuckDB.

    python tests/compare.py /root/testdata/sf0.01 [name prefix ...]
"""

from __future__ import annotations

import decimal
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, bool):
        return value
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, (float, decimal.Decimal)):
        return int(value) if float(value).is_integer() else float(value)
    return value


def as_set(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(row[i]) for i in order]) for row in rows)


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when both engines agree, otherwise a short description."""
    df = queries()[name](spark, sf_dir)
    relation = con.sql(oracle_sql()[name])
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} against {sorted(relation.columns)}"
    ours, theirs = as_set(df.columns, df.collect()), as_set(relation.columns, relation.fetchall())
    if ours == theirs:
        return None
    only = sorted(set(ours) - set(theirs))[:3], sorted(set(theirs) - set(ours))[:3]
    return f"{len(ours)} rows against {len(theirs)}; only here {only[0]}; only there {only[1]}"


def main() -> int:
    from dayledger.session import local_session

    sf_dir, prefixes = sys.argv[1], tuple(sys.argv[2:]) or ("",)
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in queries():
        if not name.startswith(prefixes) or name not in oracle_sql():
            continue
        start = time.perf_counter()
        problem = difference(spark, con, name, sf_dir)
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.perf_counter() - start:.1f}s {problem or ''}")
    print(f"{failed} differ")
    return int(failed > 0)


if __name__ == "__main__":
    raise SystemExit(main())
