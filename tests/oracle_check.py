"""Run registered queries and their SQL side by side: python tests/oracle_check.py [sf_dir] [name ...]."""

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels " \
         "conversations".split()

SAME_TYPE = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return repr(round(value, 6))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql):
    """None when equal, else what differs."""
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    kinds = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    unlike = {c: (types[c], kinds[c]) for c in names if not SAME_TYPE.get(kinds[c]) == types[c]}
    if unlike:
        return f"types {unlike}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(different)} of {len(ours)} rows, first {different[0]}" if different else None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from stratalake.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(folder), oracle_sql(), 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        if name not in sql:
            print(f"--   {name} has no SQL")
            continue
        clock = time.monotonic()
        try:
            problem = compare(query(spark, folder), con, sql[name])
        except Exception as error:  # keep going, report at the end
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.monotonic() - clock:.1f}s {problem or ''}", flush=True)
    print(f"{bad} failures")
