"""Compare every registered query with its SQL: python tests/check_oracle.py [folder] [names]."""

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tidemark.session import local_session  # noqa: E402


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


SAME_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(v[i] for i in order) for v in values), key=repr)


def compare(spark, con, folder, name):
    df = entry.queries()[name](spark, folder)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(entry.oracle_sql()[name])
    want = rows(rel.columns, rel.fetchall())
    kinds = dict(zip(rel.columns, map(str, rel.types), strict=True))
    types = {c: SAME_TYPES.get(t, t) for c, t in df.dtypes}
    return got == want and types == kinds, len(got), len(want), kinds, types


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(entry.queries())
    spark, con = local_session(), connect(folder)
    for name in wanted:
        start = time.time()
        same, n, m, sql_types, types = compare(spark, con, folder, name)
        print("OK  " if same else "DIFF", name, n, m, f"{time.time() - start:.1f}s", flush=True)
        if not same:
            print("   ", types, sql_types)


if __name__ == "__main__":
    main()
