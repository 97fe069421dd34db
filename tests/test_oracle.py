"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

duckdb = pytest.importorskip("duckdb")

from check_queries import compare, connect  # noqa: E402

from dugout.plans.catalog import ORACLE, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
# At the smallest scale no part costs enough for this filter.
MAY_BE_EMPTY = {"stat_filters"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def base():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, base, name):
    problem = compare(spark, base, FOLDER, name)
    if name in MAY_BE_EMPTY and problem == "empty on both sides":
        return
    assert problem is None


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)
