"""Plan-shape checks: the properties the scale design relies on."""

from __future__ import annotations

import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL

Q = E.queries()


def _plan(spark, name):
    df = Q[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["top_recipients", "page_after", "notification_query", "recent_receivers"])
def test_per_key_top_k_is_group_limited(spark, name):
    assert "WindowGroupLimit" in _plan(spark, name)


def test_month_slice_reaches_parquet_scan(spark):
    df = Q["peak_totals"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in text and "LessThan(ts," in text


def test_vip_rank_has_no_single_partition_window(spark):
    df = Q["vip_percent_rank"](spark, SF_SMALL)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    # percent_rank is computed inside range partitions, never as one global window.
    assert "percent_rank" not in text.lower()


def test_risk_report_scans_events_once(spark):
    text = _plan(spark, "district_risk")
    scans = [ln for ln in text.splitlines() if "FileScan parquet" in ln and "events.parquet" in ln]
    # one scan of the event rows (+ the scalar subquery that reads only user_id)
    assert sum("event_type" in ln for ln in scans) == 1


def test_column_pruning_on_fact_scan(spark):
    df = Q["province_density"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "props" not in text  # unused events column is never read


@pytest.mark.parametrize("name", ["quarter_stats"])
def test_year_and_month_windows_reach_orders_scan(spark, name):
    df = Q[name](spark, SF_SMALL)
    # The formatted explain lists every pushed filter (the one-line plan truncates them).
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(o_orderdate," in text and "LessThan(o_orderdate," in text


def test_settlement_decisions_are_not_joined_back(spark):
    text = _plan(spark, "settle_batch")
    assert "MapInPandas" in text
    assert not any("Join" in ln and "[transaction_id" in ln for ln in text.splitlines())


def test_running_balance_carry_is_broadcast(spark):
    text = _plan(spark, "running_balance")
    join_lines = [ln for ln in text.splitlines() if "Join" in ln and "_pid" in ln]
    assert join_lines and all("BroadcastHashJoin" in ln for ln in join_lines)


def test_monthly_files_are_pruned_by_month(spark):
    df = Q["top_accounts"](spark, SF_SMALL)
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(month" in text and ">= 1997-01)" in text


@pytest.mark.parametrize("name", ["flow_join", "province_flow", "export_union_dedup", "distinct_by_key",
                                  "latest_status", "account_primary", "accounts_by_user_status"])
def test_no_sort_aggregate(spark, name):
    text = _plan(spark, name)
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_stream_ingest_spreads_a_folder_over_few_files(spark):
    import os
    from remitlens.plans import cat_stream
    from remitlens.session import scratch_path
    from remitlens.streaming import pipeline
    path = cat_stream._event_files(spark, SF_SMALL, copies=2)  # every event twice: one is kept
    src = pipeline.transfer_source(spark, kind="files", path=path)
    out, ckpt = scratch_path(spark, "ingest-files"), scratch_path(spark, "ingest-ckpt")
    pipeline.stream_fact_ingest(src, out, ckpt, available_now=True).awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == rows.select("transaction_id", "direction").distinct().count() > 0
    batches = len([f for f in os.listdir(os.path.join(ckpt, "commits")) if f.isdigit()])
    folders = [d for d, _, files in os.walk(out) if any(f.endswith(".parquet") for f in files)]
    assert folders
    for d in folders:
        assert len([f for f in os.listdir(d) if f.endswith(".parquet")]) <= 4 * batches
