"""Every named query against its SQL counterpart, and the plans of some."""

import re

import pytest
from helpers import SF
from oracle_check import oracle_rows, spark_rows

from __spark_entry__ import entry, queries
from paneflow.operators.windows import pane_counts, tumbling_counts
from paneflow.plans.oracles import ORACLES
from paneflow.plans.queries import QUERIES, events, user_bind


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_what_its_sql_gives(spark, name):
    assert spark_rows(QUERIES[name](spark, SF)) == oracle_rows(SF, ORACLES[name])


def test_entry(spark):
    found = entry(spark)
    assert found.columns == ["rowkey", "window_start", "batch_no", "family", "qualifier", "value"]
    assert found.count() > 0


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def read_columns(plan):
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)))


def test_scans_read_the_columns_they_need(spark):
    assert read_columns(plan_of(tumbling_counts(events(spark, SF), "5 minutes"))) == {"ts"}
    assert read_columns(plan_of(queries()["row_key"](spark, SF))) == {"event_id", "ts", "user_id"}
    assert read_columns(plan_of(queries()["panes_count_only"](spark, SF))) == {"event_id", "ts"}


def test_filters_on_the_message_reach_the_scan(spark):
    plan = plan_of(user_bind(spark, SF).filter("event_id > 10"))
    assert "GreaterThan(event_id,10)" in plan and plan.count("from_json(ArrayType(StructType") == 1


def test_binding_moves_no_rows(spark):
    assert "Exchange" not in plan_of(user_bind(spark, SF))


def test_counts_are_made_before_the_shuffle(spark):
    plan = plan_of(pane_counts(events(spark, SF), "1 hour", 10))
    # One for the counts, one that spreads the blocks of large windows.
    assert plan.count("Exchange ") == 2 and "partial_count" in plan and "Window " not in plan
