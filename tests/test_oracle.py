"""Every registered query against its SQL twin, on the smallest given tables."""

from __future__ import annotations

import os

import pytest
from comparing import compare

from meterloom.plans.catalog import ORACLES, QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    found = compare(spark, FOLDER, QUERIES[name], ORACLES[name])
    assert found["columns"], name
    assert found["rows"][0] == found["rows"][1] > 0
    assert found["same"], found["different"]
