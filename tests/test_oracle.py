"""Every registered query against its DuckDB oracle on the smallest input."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from clickmart.plans.queries import REGISTRY
from tools.oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["utm_campaign", "utm_medium", "date_part", "sm"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=False)
    assert res[name].startswith("OK"), res[name]
