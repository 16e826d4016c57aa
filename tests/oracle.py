"""Compare a query with its SQL twin: same columns, same rows in any order."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
FAMILY = {
    "bigint": "int", "int": "int", "long": "int", "integer": "int", "smallint": "int", "hugeint": "huge",
    "double": "float", "float": "float", "string": "str", "varchar": "str", "boolean": "bool",
    "timestamp_ntz": "ts", "timestamp": "ts", "date": "date",
}


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(canonical(row[i]) for i in order) for row in rows)


def compare(spark, con, name, make, sql, folder) -> str | None:
    """None if equal, else what differs."""
    frame = make(spark, folder)
    relation = con.execute(sql)
    wanted_columns = [d[0] for d in relation.description]
    wanted_types = [str(d[1]).lower() for d in relation.description]
    wanted = rows_of(wanted_columns, relation.fetchall())
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if sorted(frame.columns) != sorted(wanted_columns):
        return f"columns {sorted(frame.columns)} != {sorted(wanted_columns)}"
    types = {c: FAMILY.get(t, t) for c, t in frame.dtypes}
    other = {c: FAMILY.get(t, t) for c, t in zip(wanted_columns, wanted_types)}
    off = {c: (types[c], other[c]) for c in types if types[c] != other[c]}
    if got != wanted:
        extra, lost = list((got - wanted).items())[:3], list((wanted - got).items())[:3]
        return f"rows {sum(got.values())} vs {sum(wanted.values())}; only spark {extra}; only sql {lost}; types {off}"
    if off:
        return f"types {off}"
    if not got:
        return "no rows on either side"
    return None


if __name__ == "__main__":
    from pulsemill.session import build_session

    import __spark_entry__ as entry

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session("8", 8)
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name, make in queries.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, name, make, oracles[name], folder)
            else:
                problem = f"no oracle, {make(spark, folder).count()} rows"
        except Exception as error:
            problem = f"{type(error).__name__} {str(error)[:700]}"
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
