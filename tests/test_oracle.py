"""Every query of the catalog against its SQL on the same tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from stayscope.catalog import QUERIES
from stayscope.equivalents import SQL
from stayscope.session import settings

NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_its_sql():
    assert set(SQL) == set(NAMES)
    assert set(NAMES) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf_dir, duck, name):
    frame = contract.queries()[name](spark, sf_dir)
    relation = duck.sql(contract.oracle_sql()[name])
    columns = sorted(frame.columns)
    assert columns == sorted(relation.columns)
    positions = [relation.columns.index(c) for c in columns]
    wanted = sorted((tuple(row[i] for i in positions) for row in relation.fetchall()), key=repr)
    found = sorted((tuple(row[c] for c in columns) for row in frame.collect()), key=repr)
    assert found
    assert found == wanted


@pytest.mark.parametrize(
    "session",
    [
        {"spark.sql.session.timeZone": "Asia/Kolkata"},
        {"spark.sql.ansi.enabled": "false"},
        {"spark.sql.adaptive.enabled": "false"},
    ],
)
@pytest.mark.parametrize("name", ["enrich_bookings", "stream_enrich", "windowed_count"])
def test_results_do_not_depend_on_the_session(spark, sf_dir, duck, name, session):
    with settings(spark, session):
        test_query_equals_sql(spark, sf_dir, duck, name)


def test_flagship(spark):
    result = contract.entry(spark)
    assert len(result.columns) == 8
    assert result.count() == 10
