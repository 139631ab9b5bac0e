"""Plan properties that must hold at scale, checked on the physical plans.

No registered query may contain a Cartesian product or nested-loop join,
evaluate Python row by row (or at all), or hint a broadcast; the main
operators keep their exchange budget; scans are pruned and filtered.
"""

import re

import pytest

from eventlens.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas",
             "lambdafunction"]  # higher-order functions fall back from whole-stage codegen


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def logical_text(df) -> str:
    return df._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_forbidden_operators(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    text = plan_text(df)
    for op in FORBIDDEN:
        assert op not in text, f"{name} plans {op}"
    assert "broadcast" not in logical_text(df).lower(), f"{name} hints a broadcast"


EXCHANGE_BUDGET = {
    "dedupe_events": 1,
    "sessions": 3,
    "session_numbers": 6,
    "daily_events": 5,
    "monthly_events": 6,
    "funnel": 4,
    "lookback_incremental_events": 1,
}


@pytest.mark.parametrize("name,budget", sorted(EXCHANGE_BUDGET.items()))
def test_exchange_budget(spark, name, budget):
    text = plan_text(QUERIES[name](spark, SF_SMALL))
    initial = text.split("== Initial Plan ==")[-1]
    shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", initial))
    assert shuffles <= budget, f"{name}: {shuffles} exchanges > {budget}"


@pytest.mark.parametrize("name,bound", [("daily_events", "LessThan(ts"),  # all history: first days
                                        ("lookback_incremental_events", "GreaterThanOrEqual(ts"),
                                        ("dedupe_events", "IsNotNull(ts"),
                                        ("date_range_filter", "GreaterThanOrEqual(ts")])
def test_scans_are_pruned_and_filtered(spark, name, bound):
    df = QUERIES[name](spark, SF_SMALL)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and all("value" not in s for s in schemas)  # unused columns never read
    assert bound in text  # the time bound reaches the reader
