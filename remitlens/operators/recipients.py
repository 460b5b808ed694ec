"""Top recipients per sender and account totals/top accounts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlens.functions import scalars as S

UNKNOWN_RECIPIENT = "Không rõ người nhận"


def recipient_totals(fact: DataFrame, start=None, end=None) -> DataFrame:
    """Per (sender user, recipient account): transfer count and amount over
    successful OUT rows with a non-blank counterparty in an optional closed range."""
    cp = S.java_trim(F.col("counterparty_account_id").cast("string"))
    rows = fact.where((F.upper(S.java_trim(F.col("direction"))) == "OUT") & S.is_success(F.col("status"))
                      & cp.isNotNull() & (cp != "") & F.col("created_at").isNotNull()
                      & F.col("amount").isNotNull())
    if start is not None:
        rows = rows.where(F.col("created_at") >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col("created_at") <= F.lit(end))
    return (rows.groupBy(F.col("owner_user_id").alias("user_id"), cp.alias("account_number"))
            .agg(F.count(F.lit(1)).alias("transfer_count"), F.sum("amount").alias("total_amount")))


def enrich_recipient_name(totals: DataFrame, accounts: DataFrame, users: DataFrame) -> DataFrame:
    """Account number → owner's name; a fixed label when absent or blank."""
    names = (accounts.select("account_number", "user_id")
             .join(users.select(F.col("user_id"), F.col("full_name")), "user_id")
             .select("account_number", F.col("full_name").alias("_name")))
    name = F.coalesce(F.nullif(S.java_trim(F.col("_name")), F.lit("")), F.lit(UNKNOWN_RECIPIENT))
    return totals.join(names, "account_number", "left").withColumn("full_name", name).drop("_name")


def recipient_candidates(totals: DataFrame, k: int = 5) -> DataFrame:
    """The (sender, recipient) rows that can still be in a sender's top ``k``.

    Exact pre-trim before the name lookup: the final order is count desc,
    amount desc, then name, so a row whose ``rank()`` on (count, amount) is
    above ``k`` already has at least ``k`` rows strictly ahead of it whatever
    the names are. ``rank() <= k`` keeps every tie at the cut (no cap), and
    Spark plans it as a WindowGroupLimit that trims each map task before the
    shuffle. The name join then touches about k rows per sender instead of
    every (sender, recipient) pair.
    """
    w = Window.partitionBy("user_id").orderBy(F.desc("transfer_count"), F.desc("total_amount"))
    return totals.withColumn("_cand", F.rank().over(w)).where(F.col("_cand") <= k).drop("_cand")


def top_recipients(named: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` per sender: count desc, amount desc, name (case-insensitive) asc.

    ``row_number() <= k`` over a user partition is planned as a
    WindowGroupLimit: each map task keeps at most k rows per user before the
    shuffle, so a sender with a huge number of recipients stays bounded.
    """
    w = Window.partitionBy("user_id").orderBy(F.desc("transfer_count"), F.desc("total_amount"),
                                              F.lower(F.col("full_name")), F.col("account_number"))
    return (named.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("user_id", F.col("rank").cast("bigint").alias("rank"), "full_name", "account_number",
                    F.col("transfer_count").cast("bigint").alias("transfer_count"),
                    F.col("total_amount").cast("double").alias("total_amount")))


def month_window(rows: DataFrame, start_month: str, end_month: str, ts: str = "created_at") -> DataFrame:
    """Rows whose time falls in the months ``start_month``..``end_month``
    ('yyyy-MM', inclusive), as a literal half-open range on ``ts`` so the scan
    of a raw transfer table can skip row groups (the month label is derived
    from the same time, so the label filter keeps the same rows)."""
    y0, m0 = (int(x) for x in start_month.split("-"))
    y1, m1 = (int(x) for x in end_month.split("-"))
    start = dt.datetime(y0, m0, 1)
    end = dt.datetime(y1 + 1, 1, 1) if m1 == 12 else dt.datetime(y1, m1 + 1, 1)
    return rows.where((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))


def total_by_account(monthly_rows: DataFrame) -> DataFrame:
    """Sum of amounts per sender account per month (no status filter).

    ``monthly_rows``: month, from_account, amount (typed rows of the monthly files).
    """
    return (monthly_rows.where(F.col("amount").isNotNull())
            .groupBy("month", "from_account").agg(F.sum("amount").alias("total_amount")))


def top_accounts(account_totals: DataFrame, start_month: str, end_month: str, k: int = 10) -> DataFrame:
    """Merge monthly account totals over the months of a range, top ``k`` by amount."""
    rows = account_totals.where(F.col("month").between(start_month, end_month))
    merged = rows.groupBy("from_account").agg(F.sum("total_amount").alias("total_amount"))
    return (merged.orderBy(F.desc("total_amount"), F.asc("from_account")).limit(k)
            .select("from_account", F.col("total_amount").cast("double").alias("total_amount")))
