from __future__ import annotations

import random
from pathlib import Path

import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def library_on_workers(spark):
    spark.sparkContext.environment["PYTHONPATH"] = str(Path(__file__).resolve().parents[2])


@pytest.fixture
def documents(spark):
    """Builds documents of (doc_id, text), or with more columns named in ``schema``."""

    def build(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture
def words():
    """Invented prose of so many words, the same for the same seed."""

    def make(count: int, seed: int = 0) -> str:
        draw = random.Random(seed)
        letters = "abcdefghijklmnopqrstuvwxyz"
        return " ".join(
            "".join(draw.choice(letters) for _ in range(draw.randint(2, 8))) for _ in range(count)
        )

    return make


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
