"""Run a catalog query and its SQL twin and compare names, types and rows."""

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if hasattr(value, "as_tuple"):
        return float(value)
    return value


KINDS = {
    "BIGINT": "bigint", "HUGEINT": "bigint", "INTEGER": "int", "VARCHAR": "string",
    "DOUBLE": "double", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


def compare(connection, sql, df):
    """Empty text when equal, otherwise what differs."""
    names = sorted(df.columns)
    relation = connection.sql(sql)
    if sorted(relation.columns) != names:
        return f"columns {sorted(relation.columns)} != {names}"
    expected_types = {
        n: KINDS.get(str(t), str(t)) for n, t in zip(relation.columns, relation.types)
    }
    types = dict(df.dtypes)
    wrong = {n: (types[n], expected_types[n]) for n in names if types[n] != expected_types[n]}
    places = [relation.columns.index(n) for n in names]
    expected = Counter(tuple(plain(r[i]) for i in places) for r in relation.fetchall())
    got = Counter(tuple(plain(r[n]) for n in names) for r in df.collect())
    if expected != got:
        extra, missing = got - expected, expected - got
        return (
            f"{sum(got.values())} rows, {sum(expected.values())} expected; {names}\n"
            f"extra {str(list(extra)[:2])[:600]}\nmissing {str(list(missing)[:2])[:600]}"
        )
    if not got:
        return "no rows"
    return f"types {wrong}" if wrong else ""
