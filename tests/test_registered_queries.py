"""Every registered query against its SQL on an independent engine."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from tidemark.workload.oracles import ORACLES
from tidemark.workload.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = driver.queries()[name](spark, SF)
    result = duck.execute(driver.oracle_sql()[name])
    names = sorted(d[0] for d in result.description)
    assert sorted(got.columns) == names
    place = [[d[0] for d in result.description].index(c) for c in names]
    expected = sorted(repr(tuple(row[i] for i in place)) for row in result.fetchall())
    assert sorted(repr(tuple(r)) for r in got.select(*names).collect()) == expected
    assert expected
