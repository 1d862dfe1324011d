"""Runs a query and its SQL side by side: names, row count and values, whatever the order."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if os.path.isdir(p) else ''}')")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in values), key=repr)


def compare(con, df, sql):
    res = con.execute(sql)
    theirs = rows([d[0] for d in res.description], res.fetchall())
    ours = rows(df.columns, [tuple(r) for r in df.collect()])
    assert ours[0] == theirs[0], (ours[0], theirs[0])
    assert len(ours[1]) == len(theirs[1]), (len(ours[1]), len(theirs[1]), ours[1][:2], theirs[1][:2])
    for a, b in zip(ours[1], theirs[1], strict=True):
        assert a == b, (a, b)
