"""Compare a query with its SQL in DuckDB, whatever the order of rows."""

import glob
import os

import duckdb


def connect(sf):
    c = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def _key(row):
    return tuple((v is not None, str(round(v, 9) + 0.0 if isinstance(v, float) else v)) for v in row)


def same(df, sql, sf):
    columns = sorted(df.columns)
    got = sorted(_key(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    made = connect(sf).sql(sql)
    assert sorted(made.columns) == columns
    want = sorted(_key(r) for r in made.select(*[f'"{c}"' for c in columns]).fetchall())
    assert got == want
