import importlib
import os

import pytest


def test_every_oracle_has_its_query():
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "p2_found" in entry.queries()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not here")
def test_flagship_query(spark):
    assert importlib.import_module("__spark_entry__").entry(spark).take(1)
