"""Physical-plan properties: no nested-loop joins where an equi-join was meant,
one exchange for the as-of core, no Python evaluation in any registered query,
filters and projections pushed into the scan."""

import pytest

import __spark_entry__ as E
from eventfeat.plans.catalog import QUERIES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_calendar_flag_is_equi_join(spark, small_dir):
    p = _plan(E.queries()["j1_near_date_flag"](spark, small_dir))
    assert "NestedLoop" not in p and "CartesianProduct" not in p


def test_asof_core_single_exchange_on_key_bucket(spark, small_dir):
    df = E.queries()["j7_asof_join"](spark, small_dir)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in p and "SortMergeJoin" not in p
    # one hash exchange of the union on (key, bucket) + one for the carry summary
    assert p.count("Exchange hashpartitioning") <= 2


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("e11", "e12"))))
def test_no_python_evaluation_no_nested_loops(spark, small_dir, name):
    p = _plan(E.queries()[name](spark, small_dir))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_pushdown_and_pruning(spark, small_dir):
    p = _plan(E.queries()["f2_between_dates"](spark, small_dir))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in p
