"""Per-user and per-account transfer history, statistics and monthly statements.

The reference answers these for one user at a time (SQL with OR predicates
over two joined sides). Here every transfer is turned into one row per
involved party (``transfer_sides``), so the same plan answers all users at
once with equi-joins and a single aggregation/window keyed by user; a
single-user query is the same plan plus a predicate on ``user_id``.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlens.functions import scalars as S

DEFAULT_START = dt.datetime(1970, 1, 1, 0, 0, 0)
DEFAULT_END = dt.datetime(2100, 12, 31, 23, 59, 59)


def with_parties(tx: DataFrame, accounts: DataFrame) -> DataFrame:
    """transactions LEFT JOIN from-account LEFT JOIN to-account (owners and numbers)."""
    fa = accounts.select(F.col("account_id").alias("from_id"), F.col("user_id").alias("from_user"),
                         F.col("account_number").alias("from_account_number"))
    ta = accounts.select(F.col("account_id").alias("to_id"), F.col("user_id").alias("to_user"),
                         F.col("account_number").alias("to_account_number"))
    return tx.join(fa, "from_id", "left").join(ta, "to_id", "left")


def transfer_sides(tx: DataFrame, accounts: DataFrame) -> DataFrame:
    """Two rows per transfer: the sender's OUT side and the receiver's IN side.

    Columns: transaction_id, user_id, side, is_self, counterparty_account,
    amount, status, created_at. Unknown owners (dangling accounts) drop out.
    """
    t = with_parties(tx, accounts)
    out_side = F.struct(F.col("from_user").alias("user_id"), F.lit("OUT").alias("side"),
                        F.col("to_account_number").alias("counterparty_account"))
    in_side = F.struct(F.col("to_user").alias("user_id"), F.lit("IN").alias("side"),
                       F.col("from_account_number").alias("counterparty_account"))
    is_self = F.col("from_user").isNotNull() & (F.col("from_user") == F.col("to_user"))
    return (t.select("transaction_id", "amount", "status", "created_at", is_self.alias("is_self"),
                     F.explode(F.array(out_side, in_side)).alias("s"))
            .where(F.col("s.user_id").isNotNull())
            .select("transaction_id", "s.user_id", "s.side", "is_self", "s.counterparty_account",
                    "amount", "status", "created_at"))


def participants(sides: DataFrame) -> DataFrame:
    """One row per (transfer, involved user): direction SELF / OUT / IN and the
    counterparty (receiver's account for the sender, incl. SELF; else sender's)."""
    return (sides.where(~(F.col("is_self") & (F.col("side") == "IN")))
            .withColumn("direction", F.when(F.col("is_self"), F.lit("SELF")).otherwise(F.col("side")))
            .drop("side", "is_self"))


def in_closed_range(df: DataFrame, start=None, end=None, col: str = "created_at") -> DataFrame:
    return df.where(F.col(col).between(F.lit(start or DEFAULT_START), F.lit(end or DEFAULT_END)))


def history_user(parts: DataFrame, start=None, end=None) -> DataFrame:
    """Transfers where the user is sender or receiver, closed time range."""
    return in_closed_range(parts, start, end)


def history_account(tx: DataFrame, accounts: DataFrame | None = None, start=None, end=None) -> DataFrame:
    """Transfers touching each account (from OR to), optional half-open [start, end).

    The OR of the per-account lookup becomes one row per distinct party id
    (explode), so all accounts are answered with equi-keys. With ``accounts``
    given, only ids of existing accounts are kept (left-semi join), as a
    lookup by account id would.
    """
    rows = tx
    if start is not None:
        rows = rows.where(F.col("created_at") >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col("created_at") < F.lit(end))
    ids = F.array_distinct(F.array(F.col("from_id"), F.col("to_id")))
    out = rows.select(F.explode(ids).alias("account_id"), *tx.columns)
    if accounts is not None:
        out = out.join(accounts.select("account_id"), "account_id", "left_semi")
    return out


def history_status_filter(hist: DataFrame, status: str) -> DataFrame:
    """Case-insensitive status filter, applied before any paging."""
    return hist.where(F.upper(F.trim(F.col("status"))) == status.strip().upper())


def pair_filter(tx: DataFrame, pairs: DataFrame) -> DataFrame:
    """Transfers whose (from_id, to_id) is in ``pairs`` (left-semi join)."""
    return tx.join(pairs.select("from_id", "to_id"), ["from_id", "to_id"], "left_semi")


def page_history(hist: DataFrame, page: int = 0, size: int = 20, key: str = "user_id") -> DataFrame:
    """One page per user, newest first (ties by transaction id desc), with
    total_elements and total_pages of the user's whole history.

    ``row_number() <= (page+1)*size`` is planned as a WindowGroupLimit, which
    trims each user's rows map-side before the shuffle (bounded per task even
    for a user holding a large share of all transfers).
    """
    w = Window.partitionBy(key).orderBy(F.desc("created_at"), F.desc("transaction_id"))
    lo, hi = page * size, (page + 1) * size
    ranked = hist.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= hi).where(F.col("_rn") > lo)
    totals = hist.groupBy(key).agg(F.count(F.lit(1)).alias("total_elements"))
    return (ranked.join(totals, key)
            .withColumn("total_pages", F.ceil(F.col("total_elements") / F.lit(size)).cast("bigint"))
            .withColumn("position", (F.col("_rn") - 1).cast("bigint")).drop("_rn"))


def page_after(hist: DataFrame, last: DataFrame, size: int = 20, key: str = "user_id") -> DataFrame:
    """Keyset paging: each user's next ``size`` rows behind the last one seen.

    ``last``: key, last_created_at, last_id, one row per user; a user without a
    row there starts at the newest. No earlier page is ranked again."""
    seen = last.select(key, "last_created_at", "last_id")
    behind = (F.col("last_id").isNull() | (F.col("created_at") < F.col("last_created_at"))
              | ((F.col("created_at") == F.col("last_created_at")) & (F.col("transaction_id") < F.col("last_id"))))
    w = Window.partitionBy(key).orderBy(F.desc("created_at"), F.desc("transaction_id"))
    return (hist.join(seen, key, "left").where(behind).drop("last_created_at", "last_id")
            .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= size)
            .withColumn("position", (F.col("_rn") - 1).cast("bigint")).drop("_rn"))


def history_cards(hist: DataFrame, key: str = "user_id") -> DataFrame:
    """Success count, pending count and amount total over the whole filtered history."""
    st = S.status_norm(F.col("status"))
    return hist.groupBy(key).agg(
        F.count_if(st == "SUCCESS").cast("bigint").alias("success_count"),
        F.count_if(st == "PENDING").cast("bigint").alias("pending_count"),
        F.sum("amount").cast("double").alias("total_amount"))


def stats_summary(parts: DataFrame, key: str | None = "user_id") -> DataFrame:
    """total, SUCCESS/PENDING/FAILED counts, total in, total out (SELF in
    neither), total amount, net = in − out. ``key=None`` = admin variant over
    all transfers (``parts`` then holds one row per transfer, in/out are 0)."""
    st = S.status_norm(F.col("status"))
    d = F.col("direction") if key else F.lit(None).cast("string")
    aggs = [
        F.count(F.lit(1)).cast("bigint").alias("total_transactions"),
        F.count_if(st == "SUCCESS").cast("bigint").alias("success_count"),
        F.count_if(st == "PENDING").cast("bigint").alias("pending_count"),
        F.count_if(st == "FAILED").cast("bigint").alias("failed_count"),
        F.coalesce(F.sum(F.when(d == "IN", F.col("amount"))), F.lit(0)).alias("_in"),
        F.coalesce(F.sum(F.when(d == "OUT", F.col("amount"))), F.lit(0)).alias("_out"),
        F.coalesce(F.sum("amount"), F.lit(0)).alias("_amt"),
    ]
    g = parts.groupBy(key).agg(*aggs) if key else parts.agg(*aggs)
    return g.select(*([key] if key else []), "total_transactions", "success_count", "pending_count",
                    "failed_count", F.col("_in").cast("double").alias("total_in"),
                    F.col("_out").cast("double").alias("total_out"),
                    F.col("_amt").cast("double").alias("total_amount"),
                    (F.col("_in") - F.col("_out")).cast("double").alias("net_amount"))


def stats_points(parts: DataFrame, group_by: str = "day", key: str | None = "user_id") -> DataFrame:
    """Totals per period (day / month / quarter / year) with its label,
    chronological within each user: grouped by the period's start alone, the
    label is formatted last, and no sort runs over all users."""
    d = F.col("direction") if key else F.lit(None).cast("string")
    keys = ([key] if key else []) + [S.period_start(F.col("created_at"), group_by).alias("period_start")]
    g = parts.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("bigint").alias("total_transactions"),
        F.coalesce(F.sum(F.when(d == "IN", F.col("amount"))), F.lit(0)).cast("double").alias("total_in"),
        F.coalesce(F.sum(F.when(d == "OUT", F.col("amount"))), F.lit(0)).cast("double").alias("total_out"),
        F.sum("amount").cast("double").alias("total_amount"))
    g = g.select(*([key] if key else []), "period_start", S.period_label(F.col("period_start"), group_by).alias("label"),
                 "total_transactions", "total_in", "total_out", "total_amount")
    return g.repartition(key).sortWithinPartitions(key, "period_start") if key else g.orderBy("period_start")


def status_breakdown(tx: DataFrame) -> DataFrame:
    return (tx.groupBy(S.status_norm(F.col("status")).alias("status"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def month_bounds(month: str):
    y, m = (int(x) for x in month.split("-"))
    return dt.datetime(y, m, 1), dt.datetime(y, m, calendar.monthrange(y, m)[1], 23, 59, 59)


def monthly_summary(sides: DataFrame, month: str) -> DataFrame:
    """Per user for one month: received, sent, profit = received − sent.
    No status filter; a self transfer counts on both sides."""
    start, end = month_bounds(month)
    rows = in_closed_range(sides, start, end)
    return (rows.groupBy("user_id").agg(
        F.coalesce(F.sum(F.when(F.col("side") == "IN", F.col("amount"))), F.lit(0)).alias("_in"),
        F.coalesce(F.sum(F.when(F.col("side") == "OUT", F.col("amount"))), F.lit(0)).alias("_out"))
        .select("user_id", F.lit(month).alias("month"), F.col("_in").cast("double").alias("total_received"),
                F.col("_out").cast("double").alias("total_sent"),
                (F.col("_in") - F.col("_out")).cast("double").alias("profit")))


def monthly_range(sides: DataFrame, start, end) -> DataFrame:
    """The same per (user, yyyy-MM) over a closed range, chronological within
    each user (no sort over all users)."""
    rows = in_closed_range(sides, start, end)
    return (rows.groupBy("user_id", S.month_of(F.col("created_at")).alias("month")).agg(
        F.coalesce(F.sum(F.when(F.col("side") == "IN", F.col("amount"))), F.lit(0)).alias("_in"),
        F.coalesce(F.sum(F.when(F.col("side") == "OUT", F.col("amount"))), F.lit(0)).alias("_out"))
        .select("user_id", "month", F.col("_in").cast("double").alias("total_received"),
                F.col("_out").cast("double").alias("total_sent"),
                (F.col("_in") - F.col("_out")).cast("double").alias("profit"))
        .repartition("user_id").sortWithinPartitions("user_id", "month"))
