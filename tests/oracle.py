"""Compare a Spark result with DuckDB SQL over the same files."""

import math

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19]
    return v


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)


def duck_rows(sql, folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
    rel = con.sql(sql)
    names = sorted(rel.columns)
    at = [rel.columns.index(c) for c in names]
    return names, sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
