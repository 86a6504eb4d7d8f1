"""Run queries against their SQL on the same tables; also usable as a script:

python tests/compare.py SF_DIR [QUERY ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def database(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _rows(arrow) -> list[tuple]:
    names = sorted(arrow.column_names)
    columns = [arrow.column(n).to_pylist() for n in names]
    return sorted(zip(*columns, strict=True), key=repr)


def differences(df, con, sql: str) -> list[str]:
    """What differs in columns, types, row count or values; nothing where all agree."""
    ours, theirs = df.toArrow(), con.sql(sql).to_arrow_table()
    found = []
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return [f"columns {sorted(ours.column_names)} != {sorted(theirs.column_names)}"]
    for name in ours.column_names:
        a, b = str(ours.schema.field(name).type), str(theirs.schema.field(name).type)
        if a.replace("large_", "") != b.replace("large_", ""):
            found.append(f"type of {name}: {a} != {b}")
    if ours.num_rows != theirs.num_rows:
        found.append(f"rows {ours.num_rows} != {theirs.num_rows}")
    a, b = _rows(ours), _rows(theirs)
    # As text: -0.0 and 0.0 are not the same.
    unequal = [(x, y) for x, y in zip(a, b, strict=False) if repr(x) != repr(y)]
    if unequal:
        found.append(f"{len(unequal)} unequal rows, first {unequal[0]}")
    return found


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from lagscope.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = database(sf_dir), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            found = differences(df, con, sqls[name])
        except Exception as error:  # report and go on
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok':4} {name:32} {time.time() - start:6.2f}s", *found, flush=True)
    print(f"{bad} failed")
