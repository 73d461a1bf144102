"""Run registered queries next to their oracle SQL and compare the results."""

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(v)) for v in row)


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted([tuple(_plain(r[i]) for i in order) for r in rows], key=_key)


def differences(spark, con, query, sql, sf_dir, limit=3):
    """Empty when both sides agree in names, row count and every value."""
    df = query(spark, sf_dir)
    names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    want_names, want = rows_of([d[0] for d in res.description], res.fetchall())
    if names != want_names:
        return [f"columns {names} != {want_names}"], len(got)
    out = [] if len(got) == len(want) else [f"{len(got)} rows != {len(want)}"]
    bad = [(a, b) for a, b in zip(got, want) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    if bad:
        out.append(f"{len(bad)} rows differ, {names}: {bad[:limit]}")
    return out, len(got)
