from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from base_match import BASE_MATCH

from matchstats.schemas import RAW_SCHEMA
from matchstats.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        "matchstats-tests",
        spark__sql__warehouse__dir=str(root / "warehouse"),
        spark__checkpoint__dir=str(root / "shared"),
        # Plans are read as text in the tests.
        spark__sql__maxMetadataStringLength="100000",
        spark__sql__debug__maxToStringFields="1000",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Builds raw matches from the base match and the given changes, one row per dict."""

    def build(*changes: dict):
        rows = [tuple((BASE_MATCH | change)[n] for n in RAW_SCHEMA.names) for change in changes]
        return spark.createDataFrame(rows, RAW_SCHEMA)

    return build
