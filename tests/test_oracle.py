"""Registered queries against their SQL on the smallest data set.

A sample runs by default; ``ALL_QUERIES=1`` runs every one.
"""

import os
from pathlib import Path

import pytest

import __spark_entry__ as entry
from shortfall.plans import registry
from tools.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
SAMPLE = [
    "waterfall_detail", "vendor_availability", "fe_issue", "star_explain", "po_raised",
    "scan_tsv_roundtrip", "reco_weekly_scan", "join_nullsafe", "sum_strict", "unpivot_leadtime",
]

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data here")


@pytest.mark.parametrize("name", registry.queries() if os.environ.get("ALL_QUERIES") else SAMPLE)
def test_query_equals_sql(spark, name):
    problem, _ = compare(spark, connect(SF_DIR), name, SF_DIR)
    assert problem is None, problem


def test_every_query_has_sql():
    assert set(registry.oracle_sql()) == set(registry.queries())
    assert set(registry.queries()) <= set(entry.queries())
