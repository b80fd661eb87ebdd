"""Random batches: table step and plain step against an ordered MERGE in DuckDB."""

import random

import duckdb
import pytest

from helpers import day, feed, rows, tables, versions
from tidemark.plans.scd2_step import apply_scd2_batch, scd2_step

SETUP = """
CREATE TABLE target ("JoinKey" VARCHAR, id BIGINT, price VARCHAR, name VARCHAR,
  active BOOLEAN, eff DATE, until DATE, action VARCHAR);
CREATE TABLE batch ("JoinKey" VARCHAR, id BIGINT, price VARCHAR, name VARCHAR,
  op_type VARCHAR, ds DATE, pos BIGINT);
"""
STAGE = """
CREATE OR REPLACE TABLE newest AS SELECT * FROM batch
  QUALIFY row_number() OVER (PARTITION BY "JoinKey" ORDER BY ds DESC NULLS LAST, pos DESC) = 1;
CREATE OR REPLACE TABLE staged AS
  SELECT NULL::VARCHAR AS mk, n.* FROM newest n JOIN target t ON t."JoinKey" = n."JoinKey"
    WHERE t.active AND t.price <> n.price
  UNION ALL SELECT "JoinKey", * FROM newest;
"""
MERGE = """
MERGE INTO target t USING staged s ON t."JoinKey" = s.mk
WHEN MATCHED AND t.active AND t.price <> s.price THEN
  UPDATE SET active = false, until = s.ds, action = s.op_type
WHEN MATCHED AND t.active AND s.op_type = 'd' THEN
  UPDATE SET active = false, until = s.ds, action = s.op_type
WHEN MATCHED AND t.name <> s.name THEN UPDATE SET name = s.name
WHEN NOT MATCHED THEN INSERT
  VALUES (s."JoinKey", s.id, s.price, s.name, true, s.ds, NULL, s.op_type)
"""


def draw(rng, n):
    out = []
    for i in range(n):
        # key 1 holds about a third of all rows
        key = 1 if rng.random() < 0.33 else rng.choice([2, 3, 4, 5, 6, 7, 8, None])
        out.append(
            (
                key,
                rng.choice(["10", "20", "30", None]),
                rng.choice(["a", "b", None]),
                rng.choice("cuudD"),
                rng.choice([1, 2, 3, 4, 5, None]),
                i,
            )
        )
    return out


@pytest.mark.parametrize("seed, settings", [
    (1, {}),
    (2, {"broadcast_bytes": 0}),
    (3, {"broadcast_bytes": 0, "hot_versions": 2}),
])
def test_batches_match_merge(spark, tmp_path, seed, settings):
    rng = random.Random(seed)
    con = duckdb.connect()
    con.execute(SETUP)
    a_feed = feed(**settings)
    table = plain = None
    for number in range(5):
        batch = draw(rng, rng.choice([3, 8, 40]))
        frame = rows(spark, *batch)
        if table is None:
            table = tables(spark, frame.drop("_offset"), a_feed, tmp_path).scd2
            plain = spark.createDataFrame([], spark.table(table.sql_name).schema)
        apply_scd2_batch(spark, frame, table, a_feed, number)
        plain = scd2_step(plain, frame, a_feed).checkpoint()

        con.execute("DELETE FROM batch")
        con.executemany(
            "INSERT INTO batch VALUES (?, ?, ?, ?, ?, ?, ?)",
            [
                ("" if k is None else str(k), k, p, n, op, d and day(d), pos)
                for k, p, n, op, d, pos in batch
            ],
        )
        con.execute(STAGE)
        con.execute(MERGE)
        expected = sorted(
            (
                (k, p, n, a, e and e.day, u and u.day, act)
                for k, p, n, a, e, u, act in con.execute(
                    'SELECT "JoinKey", price, name, active, eff, until, action FROM target'
                ).fetchall()
            ),
            key=repr,
        )
        got = versions(spark.table(table.sql_name))
        assert got == expected
        assert versions(plain) == expected
        active = [v[0] for v in got if v[3]]
        assert len(active) == len(set(active))
