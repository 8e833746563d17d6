"""Every registered query against its SQL on the smallest data."""

import os

import pytest
from parity import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, con, name):
    message = compare(spark, con, FOLDER, name)
    assert message.startswith("ok"), message


def test_top_k_cuts_contexts_before_the_shuffle(spark):
    assert "WindowGroupLimit" in queries()["top_k"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    plan = queries()["prompt_support"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(role,user)" in plan
    plan = queries()["shuffle"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan and "ReadSchema: struct<doc_id:bigint>" in plan


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    rows = entry(spark).collect()
    assert rows and all(r.padded_tokens % 8 == 0 for r in rows)
