"""The driver contract, and the models against the oracle at the smallest scale."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from checks.compare import differences, open_oracle
from checks.oracles import all_oracles
from checks.queries import all_queries

SF = "/root/testdata/sf0.001"
COMPARED = ["fact_sales", "dim_customers", "dim_products", "dim_dates", "fact_daily_revenue",
            "rfm_scores", "anomaly_flags", "gate_gold", "schema_tests", "src_cdc_diff"]


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_oracles_read_the_given_tables():
    given = re.compile(r"\b(from|join) (customer|orders|lineitem|part|nation)\b")
    for name, sql in all_oracles().items():
        assert given.search(sql), name


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() == 1500 and frame.columns[0] == "order_id"


@pytest.mark.parametrize("name", COMPARED)
def test_equal_to_the_oracle(spark, name):
    frame = entry.queries()[name](spark, SF)
    assert differences(frame, entry.oracle_sql()[name], open_oracle(SF)) == []
