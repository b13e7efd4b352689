"""Every query against its SQL in another engine, on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from lexmill.queries.checks import CHECKS
from lexmill.queries.registry import QUERIES

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    frame = QUERIES[name](spark, str(SF))
    columns = sorted(frame.columns)
    cursor = db.execute(CHECKS[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    assert Counter(tuple(r) for r in frame.select(*columns).collect()) == theirs
