"""Compare a query with its SQL twin in DuckDB: names, types, rows and values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

# Spark type -> DuckDB types that stand for it.
SAME_TYPE = {
    "string": {"VARCHAR"},
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _key(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_key(row[i]) for i in order) for row in rows)


def compare(df, con, sql):
    """A list of differences, empty if there are none."""
    found = con.execute(sql)
    types = {c[0]: str(c[1]) for c in found.description}
    rows = found.fetchall()
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    types = {name: kind for name, kind, *_ in described}
    if set(types) != set(df.columns):
        return [f"columns: {sorted(df.columns)} against {sorted(types)}"]
    problems = [
        f"type of {name}: {kind} against {types[name]}"
        for name, kind in df.dtypes
        if types[name] not in SAME_TYPE.get(kind, {kind.upper()})
    ]
    names = [d[0] for d in described]
    got, wanted = _rows(df.columns, df.collect()), _rows(names, rows)
    if len(got) != len(wanted):
        problems.append(f"rows: {len(got)} against {len(wanted)}")
    elif got != wanted:
        pairs = [(g, w) for g, w in zip(got, wanted, strict=True) if g != w]
        problems.append(f"{len(pairs)} rows differ, first {pairs[0]}")
    return problems
