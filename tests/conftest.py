import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark():
    from shelfmark.session import build_session
    session = build_session("tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Values of Column expressions over one row: evaluate(lambda: [columns])."""
    def run(*columns):
        row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
        return row[0] if len(columns) == 1 else list(row)
    return run
