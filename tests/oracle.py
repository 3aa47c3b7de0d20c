"""Compare registered queries with their SQL in DuckDB: names, types, rows and values."""

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "FLOAT": "float",
    "BOOLEAN": "boolean",
}


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=0, abs_tol=0) or (math.isnan(a) and math.isnan(b))
    return a == b and type(a) is type(b)


def compare(df, con, sql):
    """A list of differences, empty if the query and its SQL agree."""
    problems = []
    names = sorted(df.columns)
    out = con.sql(sql)
    if sorted(out.columns) != names:
        return [f"columns {names} against {sorted(out.columns)}"]
    types = dict(zip(out.columns, map(str, out.types)))
    for f in df.schema:
        if TYPES.get(types[f.name]) != f.dataType.simpleString():
            problems.append(f"type of {f.name}: {f.dataType.simpleString()} against {types[f.name]}")
    mine = sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_key)
    cols = ", ".join(f'"{n}"' for n in names)
    theirs = sorted((tuple(r) for r in out.project(cols).fetchall()), key=_key)
    if len(mine) != len(theirs):
        return problems + [f"rows {len(mine)} against {len(theirs)}"]
    wrong = [(a, b) for a, b in zip(mine, theirs) if not all(map(_same, a, b))]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return problems
