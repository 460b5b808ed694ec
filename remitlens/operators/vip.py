"""Top-5 % customers of a year by successful outgoing amount."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.operators.ranking import percent_rank_global


def year_bounds(year: int):
    return dt.datetime(year, 1, 1), dt.datetime(year + 1, 1, 1)


def vip_totals(tx: DataFrame, accounts: DataFrame, users: DataFrame, year: int) -> DataFrame:
    """SUM(amount), COUNT per (user, account) for status = 'SUCCESS' transfers in
    ``[Jan 1, next Jan 1)``; transactions ⋈ sender account ⋈ user (inner).

    The filter runs before the joins and the sum is partially aggregated per
    sender account before joining, so the joins see one row per sender.
    """
    start, end = year_bounds(year)
    per_account = (tx.where((F.col("status") == "SUCCESS") & (F.col("created_at") >= F.lit(start))
                            & (F.col("created_at") < F.lit(end)))
                   .groupBy(F.col("from_id").alias("account_id"))
                   .agg(F.sum("amount").alias("total_amount"), F.count(F.lit(1)).alias("total_txn")))
    a = accounts.select("account_id", "user_id", "account_number")
    u = users.select("user_id", "full_name")
    joined = per_account.join(a, "account_id").join(u, "user_id")
    return (joined.groupBy("user_id", "full_name", "account_number")
            .agg(F.sum("total_amount").alias("total_amount"), F.sum("total_txn").alias("total_txn")))


def vip_percent_rank(totals: DataFrame, min_pct: float = 0.95) -> DataFrame:
    """Customers with PERCENT_RANK() OVER (ORDER BY total ASC) ≥ ``min_pct``,
    ordered by total desc (a lone customer has rank 0 and is excluded)."""
    ranked = percent_rank_global(totals, "total_amount")
    return (ranked.where(F.col("pct_rank") >= min_pct)
            .orderBy(F.desc("total_amount"), "user_id"))


def vip_summary(vips: DataFrame) -> DataFrame:
    """Count, total amount, transaction total and average over the VIP list."""
    return vips.agg(F.count(F.lit(1)).cast("bigint").alias("vip_count"),
                    F.sum("total_amount").cast("double").alias("total_amount"),
                    F.sum("total_txn").cast("bigint").alias("total_transactions"),
                    (F.sum("total_amount").cast("double") / F.count(F.lit(1))).alias("avg_amount"))
