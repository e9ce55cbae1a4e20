"""Every registered query against its SQL in another engine.

Runs on the smallest tables, or on those ``MATCHSTATS_SF_DIR`` names.
"""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered

SF_DIR = os.environ.get("MATCHSTATS_SF_DIR", "/root/testdata/sf0.001")
DUCK_TYPES = {
    "VARCHAR": "string", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double",
    "BOOLEAN": "boolean", "DATE": "date",
}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_an_oracle():
    """But for those of trained models and seeded draws, tested elsewhere."""
    without = set(registered.queries()) - set(registered.oracle_sql())
    assert not set(registered.oracle_sql()) - set(registered.queries())
    assert all(name == "pipeline" or name.startswith("op") for name in without)


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    frame = registered.queries()[name](spark, SF_DIR)
    relation = duck.sql(registered.oracle_sql()[name])
    expected_types = {c: DUCK_TYPES[str(t)] for c, t in zip(relation.columns, relation.types)}
    assert dict(frame.dtypes) == expected_types
    columns = sorted(expected_types)

    def rows(tuples, names):
        order = [list(names).index(c) for c in columns]
        picked = [tuple(t[i] for i in order) for t in tuples]
        return sorted(picked, key=lambda t: tuple((v is None, str(v)) for v in t))

    actual = rows([tuple(r) for r in frame.collect()], frame.columns)
    expected = rows(relation.fetchall(), relation.columns)
    assert actual == expected
    assert actual, "an empty result proves nothing"


def test_entry(spark, duck):
    """The flagship: league tables of every season in the smallest tables."""
    tables = len(duck.sql(registered.oracle_sql()["league_table"]).fetchall())
    if SF_DIR.endswith("sf0.001"):
        assert registered.entry(spark).count() == tables
