"""Plan properties the design relies on (see PLANS.md)."""

from __future__ import annotations

import pytest

import __spark_entry__ as se

SF = "/root/testdata/sf0.001"


def _plan(spark, name: str) -> str:
    df = se.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_aggregate_id_filter_reaches_the_scans(spark):
    p = _plan(spark, "fold_one")
    assert "EqualTo(o_orderkey,8)" in p and "EqualTo(l_orderkey,8)" in p


@pytest.mark.parametrize("name,partial", [("kpi_1m", "partial_count"),
                                          ("cdc_apply", "partial_max_by"),
                                          ("dedup_first", "partial_min_by"),
                                          ("fold_all", "partial_sum")])
def test_map_side_partial_aggregation(spark, name, partial):
    assert partial in _plan(spark, name)


@pytest.mark.parametrize("name", ["high_value_tier", "cdc_status_change", "encode_json"])
def test_row_local_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in _plan(spark, name)


def test_rolling_series_has_no_whole_data_window(spark):
    p = _plan(spark, "rolling_series")
    # The only single-partition exchange feeds the n-row partition-offset
    # window; the data itself is scanned in range partitions.
    assert p.count("SinglePartition") <= 1
    assert "MapInPandas" in p


def test_column_pruning_on_events(spark):
    p = _plan(spark, "kpi_1m")
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in p
