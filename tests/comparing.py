"""Compare registered queries with their SQL on the same parquet files."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


_KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}


def differences(df, con, sql: str) -> list[str]:
    """What differs between a DataFrame and a SQL result; empty if nothing does."""
    result = con.execute(sql)
    theirs_types = {d[0]: str(d[1]) for d in result.description}
    theirs = result.fetchall()
    ours_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if sorted(ours_types) != sorted(theirs_types):
        return [f"columns {sorted(ours_types)} != {sorted(theirs_types)}"]
    found = [
        f"type of {n}: {t} != {theirs_types[n]}"
        for n, t in ours_types.items()
        if _KINDS.get(t, t) != theirs_types[n]
    ]
    a = _rows(df.columns, [tuple(r) for r in df.collect()])
    b = _rows(list(theirs_types), theirs)
    if len(a) != len(b):
        found.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        found += [_first_difference(x, y) for x, y in zip(a, b, strict=False) if x != y][:2]
    return found


def _first_difference(x: tuple, y: tuple) -> str:
    a, b = repr(x), repr(y)
    at = next((i for i, (c, d) in enumerate(zip(a, b, strict=False)) if c != d), min(len(a), len(b)))
    return f"values at {at}: {a[max(0, at - 40) : at + 80]!r} != {b[max(0, at - 40) : at + 80]!r}"
