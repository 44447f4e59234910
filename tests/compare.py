"""Comparing a Spark result with DuckDB's, without regard to row or column order."""

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def differences(df, con, sql):
    """A description of how the two differ, or None."""
    columns = sorted(df.columns)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns: {columns} against {sorted(names)}"
    order = [names.index(c) for c in columns]
    want = Counter(tuple(r[i] for i in order) for r in result.fetchall())
    got = Counter(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    if want == got:
        return None
    only_spark, only_duck = got - want, want - got
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; {columns}\n"
        f"only Spark ({sum(only_spark.values())}): {list(only_spark)[:3]}\n"
        f"only DuckDB ({sum(only_duck.values())}): {list(only_duck)[:3]}"
    )
