"""Bucketed history, stores written once, slice summaries."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from remitlens.operators import density, history, peak, risk, slice_summary
from remitlens.plans.model_frames import Frames
from remitlens.session import scratch_path
from remitlens.sources import fact_table, history_table, stores

from .conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def histories(spark):
    parts = Frames(spark, SF_SMALL).tx_parts
    return parts, history_table.create(parts, buckets=8)


def test_pages_of_all_users_without_exchange(spark, histories):
    parts, name = histories
    for page, size in ((0, 20), (1, 3)):
        got = history_table.pages(spark, name, page, size)
        want = history.page_history(parts, page, size).select(*got.columns)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        text = _plan(got)
        assert "Exchange" not in text and text.count("FileScan") == 1


def test_a_page_of_one_user_reads_one_bucket(spark, histories):
    parts, name = histories
    user = parts.groupBy("user_id").count().orderBy(F.desc("count"), "user_id").first()["user_id"]
    got = history_table.page_of_user(spark, name, user, 0, 5)
    want = history.page_history(parts.where(F.col("user_id") == user), 0, 5).select(*got.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert "SelectedBucketsCount: 1 out of 8" in _plan(got)


def test_a_transfer_by_id(spark, histories):
    parts, name = histories
    one = parts.first()["transaction_id"]
    got = history_table.transfer(spark, name, one)
    want = parts.where(F.col("transaction_id") == one).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_users_are_dealt_over_several_keys(spark):
    parts = Frames(spark, SF_SMALL).tx_parts
    parts = parts.withColumn("user_id", F.when(F.col("transaction_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id"))) \
        .dropDuplicates(["user_id", "transaction_id"])  # one user with a third of all rows
    parts = parts.checkpoint()
    name = history_table.create(parts, buckets=8, hot_rows=200)
    keys = spark.table(name).where("user_id = 7").groupBy("_key").count().collect()
    assert len(keys) >= 3 and max(r["count"] for r in keys) < 400
    for page, size in ((0, 20), (2, 7)):
        got = history_table.pages(spark, name, page, size)
        want = history.page_history(parts, page, size).select(*got.columns)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        one = history_table.page_of_user(spark, name, 7, page, size)
        assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, want.where("user_id = 7").collect()), key=str)


def test_a_store_is_written_once_per_version(spark):
    path, built = scratch_path(spark, "source"), []

    def build():
        built.append(1)
        return f"store-{len(built)}"

    spark.range(3).write.parquet(path)
    assert [stores.once(spark, "s", [path], build) for _ in range(2)] == ["store-1"] * 2
    assert stores.once(spark, "other", [path], build) == "store-2"
    spark.range(1).write.mode("append").parquet(path)  # a new file is a new version
    assert stores.once(spark, "s", [path], build) == "store-3" and len(built) == 3


def _reports(spark, fact, summary):
    """(from the rows, from the summary) of each report."""
    sets = [F.sum("n").alias("n"), F.sum("amount").alias("amount")]
    totals = peak.peak_totals(fact, "2024-01", ("HOUR_TOTAL", "DAY_TOTAL"))
    totals = totals.groupBy("level", F.coalesce("hour", "day").alias("key")).agg(*sets)
    rows = fact.where((F.col("year") == 2024) & F.col("amount").isNotNull() & (F.col("status") != ""))
    quarters = rows.groupBy("quarter").agg(F.sum("amount").alias("total_amount"), F.count(F.lit(1)).alias("tx_count"),
                                           F.count_if(F.upper("status") == "SUCCESS").alias("success_count"))
    return [(density.province_density(fact.where("amount IS NOT NULL")), slice_summary.province_density(summary)),
            (totals, slice_summary.peak_totals(summary, "2024-01")), (quarters, slice_summary.quarter_totals(summary, 2024))]


def test_only_changed_slices_are_summarised_again(spark):
    fact = Frames(spark, SF_SMALL).fact
    name = fact_table.create(fact, fact_table.fresh_name(spark, "fact"))
    summary = slice_summary.create(spark, name, fact_table.fresh_name(spark, "summary"))
    all_slices = {tuple(r) for r in fact_table.list_partitions(spark, name).collect()}

    def check():
        for rows, merged in _reports(spark, spark.table(name), spark.table(summary)):
            assert sorted(map(str, rows.collect())) == sorted(map(str, merged.select(*rows.columns).collect()))
        exact = {r[0]: r[1] for r in risk.fan_out(risk.quarter_slice(spark.table(name), 2024, "Q1")).collect()}
        about = {r[0]: r[1] for r in slice_summary.fan_out(spark.table(summary), 2024, "Q1").collect()}
        assert exact.keys() == about.keys() and all(abs(about[d] - n) <= max(2, 0.03 * n) for d, n in exact.items())

    assert set(slice_summary.refresh(spark, name, summary)) == all_slices
    check()
    assert slice_summary.refresh(spark, name, summary) == []
    one = sorted(all_slices)[0]
    fact_table.append(fact_table_slice(fact, one), name)  # one appended slice: only it is scanned
    spark.catalog.refreshTable(name)
    assert slice_summary.refresh(spark, name, summary) == [one]
    check()
    fact_table.delete_partition(spark, name, *one)
    spark.catalog.refreshTable(name)
    assert slice_summary.refresh(spark, name, summary) == []
    check()


def fact_table_slice(fact, one):
    province, district, year, quarter = one
    return fact.where((F.col("province") == province) & (F.col("district") == district) & (F.col("year") == year)
                      & (F.col("quarter") == quarter))
