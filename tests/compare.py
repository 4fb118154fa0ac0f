"""Row-for-row comparison of a Spark result with its SQL oracle."""

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir, f"{name}.parquet")
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return Counter(tuple(_plain(row[at]) for at in order) for row in rows)


def compare(spark, connection, query, sql, sf_dir) -> tuple[int, list[str]]:
    """Number of rows and the differences found, if any."""
    frame = query(spark, sf_dir)
    found = connection.execute(sql)
    names = [column[0] for column in found.description]
    expected = found.fetchall()
    got = [tuple(row) for row in frame.collect()]
    problems = []
    if sorted(names) != sorted(frame.columns):
        return len(got), [f"columns {sorted(frame.columns)} against {sorted(names)}"]
    if len(got) != len(expected):
        problems.append(f"{len(got)} rows against {len(expected)}")
    left, right = bag(frame.columns, got), bag(names, expected)
    for side, rest in (("only here", left - right), ("only in oracle", right - left)):
        if rest:
            problems.append(f"{side}: {rest.total()} rows, such as {next(iter(rest))}")
    types = {type(value) for row in got[:50] for value in row}
    wanted = {type(value) for row in expected[:50] for value in row}
    if not problems and types != wanted:
        problems.append(f"value types {types} against {wanted}")
    return len(got), problems
