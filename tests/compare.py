"""Run a query and its SQL side by side and report the first difference."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if names, kinds of types and all values agree, row order aside."""
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    kinds = {c[0]: str(c[1]) for c in rel.description}
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    spark_kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                   "boolean": "BOOLEAN"}
    order = sorted(names)
    wrong = [
        f"{n}: {t} vs {kinds[n]}" for n, t in df.dtypes if spark_kinds.get(t, t) != kinds[n]
    ]
    theirs = sorted(
        (tuple(r[names.index(c)] for c in order) for r in rel.fetchall()), key=_key
    )
    ours = sorted((tuple(r[c] for c in order) for r in df.collect()), key=_key)
    if wrong:
        return f"types {wrong}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    for a, b in zip(ours, theirs):
        same = all(
            x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
            for x, y in zip(a, b)
        )
        if not same:
            return f"{order}: {a} vs {b}"
    return None
