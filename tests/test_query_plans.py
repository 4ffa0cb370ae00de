"""Shapes that would not survive large data must not appear in any registered query's plan."""

import pytest

from __spark_entry__ import queries
from tests.conftest import SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "CollectLimit")


STREAMED = {"scd2_stream", "scd2_incremental", "partitioned_append"}


@pytest.mark.parametrize("name", [q for q in sorted(set(queries()) - STREAMED) if not q.startswith("lake_")])
def test_plan(spark, name):
    text = queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert [word for word in FORBIDDEN if word in text] == []


def test_rebuild_reduces_before_it_shuffles(spark):
    text = queries()["scd2_history"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    lowest = text[text.rindex("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in lowest
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_aggregations_are_partial_first(spark):
    for name in ("agg_tier_stats", "agg_two_keys", "distinct_keys", "value_counts", "json_key_profile"):
        text = queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        below = text[text.rindex("Exchange hashpartitioning"):]
        assert "HashAggregate" in below or "SortAggregate" in below or "ObjectHashAggregate" in below, name
