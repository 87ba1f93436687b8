"""Compares a registered query with its SQL twin."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if hasattr(value, "asDict"):
        return tuple(plain(x) for x in value.asDict().values())
    if isinstance(value, dict):
        return tuple(plain(x) for x in value.values())
    if isinstance(value, (list, tuple)):
        return tuple(plain(x) for x in value)
    return round(value, 6) if isinstance(value, float) else value


def both(df, sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    found = con.sql(sql)
    columns = sorted(df.columns)
    assert columns == sorted(found.columns)
    at = [found.columns.index(c) for c in columns]
    left = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    right = sorted((tuple(plain(r[k]) for k in at) for r in found.fetchall()), key=repr)
    return left, right
