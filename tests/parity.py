"""Run registered queries and their SQL side by side.

``python tests/parity.py [sf_dir] [query ..]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def compare(spark, connection, sf_dir: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    frame = entry.queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    ours = Counter(tuple(row) for row in frame.select(*[f"`{c}`" for c in columns]).collect())
    result = connection.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    if ours != theirs:
        return (
            f"{sum(ours.values())} rows against {sum(theirs.values())}; "
            f"only here {list((ours - theirs).items())[:2]}; only there {list((theirs - ours).items())[:2]}"
        )
    return None


if __name__ == "__main__":
    from session import session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(entry.oracle_sql())
    spark, connection = session(), duck(folder)
    for name in chosen:
        begun = time.time()
        try:
            difference = compare(spark, connection, folder, name)
        except Exception as error:  # noqa: BLE001
            difference = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name} {time.time() - begun:.1f}s {'ok' if difference is None else difference}", flush=True)
