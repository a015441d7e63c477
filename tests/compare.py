"""A query's rows against those of its SQL."""

from __future__ import annotations

import os
from collections import Counter

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def database():
    import duckdb

    con = duckdb.connect()
    for f in sorted(os.listdir(FOLDER)):
        con.execute(f"create view {f.split('.')[0]} as select * from '{FOLDER}/{f}'")
    return con


def _plain(row, order):
    return tuple(round(v, 6) if isinstance(v, float) else v for v in (row[i] for i in order))


def check(spark, con, query, sql) -> None:
    df = query(spark, FOLDER)
    got = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in got.description}
    assert {c: _TYPES.get(t, t) for c, t in df.dtypes} == kinds
    names = [d[0] for d in got.description]
    mine = sorted(range(len(df.columns)), key=df.columns.__getitem__)
    theirs = sorted(range(len(names)), key=names.__getitem__)
    assert Counter(_plain(r, mine) for r in df.collect()) == Counter(_plain(r, theirs) for r in got.fetchall())
