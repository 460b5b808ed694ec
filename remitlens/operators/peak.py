"""Peak transfer hours/days of a month: totals, peak windows, dense charts, top users."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.functions import scalars as S
from remitlens.session import materialize

NO_DATA = "Không có dữ liệu"

# grouping_id() values of the four grouping sets (bit set = column not grouped;
# column order hour, day, owner_user_id, owner_account_id).
LEVELS = {"HOUR_TOTAL": 0b0111, "HOUR_USER": 0b0100, "DAY_TOTAL": 0b1011, "DAY_USER": 0b1000}
GROUPING_SETS = {"HOUR_TOTAL": ["hour"], "HOUR_USER": ["hour", "owner_user_id", "owner_account_id"],
                 "DAY_TOTAL": ["day"], "DAY_USER": ["day", "owner_user_id", "owner_account_id"]}
TOTAL_LEVELS = ("HOUR_TOTAL", "DAY_TOTAL")


def month_rows(fact: DataFrame, month: str) -> DataFrame:
    """Successful OUT rows of the stored month column (SUCCESS or COMPLETED).

    Like the reference, only the month's year/quarter partition is read; the
    month is also stated as a literal created_at range (the stored month is
    derived from created_at) so raw-table scans can skip row groups.
    """
    y, m = (int(x) for x in month.split("-"))
    start = dt.datetime(y, m, 1)
    end = dt.datetime(y + 1, 1, 1) if m == 12 else dt.datetime(y, m + 1, 1)
    ts = F.col("created_at")
    return fact.where((F.col("year") == y) & (F.col("quarter") == f"Q{(m - 1) // 3 + 1}")
                      & (ts >= F.lit(start)) & (ts < F.lit(end))
                      & (F.upper(S.java_trim(F.col("direction"))) == "OUT")
                      & S.is_success(F.col("status"))
                      & (S.java_trim(F.col("month")) == month)
                      & F.col("amount").isNotNull())


def peak_totals(fact: DataFrame, month: str, levels=tuple(LEVELS)) -> DataFrame:
    """count+sum by hour, hour×user×account, day, day×user×account — one scan.

    GROUPING SETS → a single Expand + hash aggregate (partial before the
    shuffle), instead of four emissions per row through four jobs. ``levels``
    picks the sets to compute (the charts and the peak window need only the
    hour and day totals, not the per-user rows); level ids stay the same.
    """
    rows = month_rows(fact, month).select(
        F.hour("created_at").alias("hour"), F.dayofmonth("created_at").alias("day"),
        "owner_user_id", "owner_account_id", "amount")
    g = rows.groupingSets([GROUPING_SETS[lv] for lv in levels],
                          "hour", "day", "owner_user_id", "owner_account_id")
    agg = g.agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"),
                F.grouping_id().alias("gid"))
    level = F.lit(None).cast("string")
    for name, gid in LEVELS.items():
        level = F.when(F.col("gid") == gid, F.lit(name)).otherwise(level)
    return agg.select(level.alias("level"), "hour", "day", "owner_user_id", "owner_account_id",
                      "n", "amount")


def _peak_key(totals: DataFrame, level: str, key: str) -> DataFrame:
    """The key with most transactions, then most amount, then smallest key."""
    t = totals.where(F.col("level") == level)
    return t.agg(F.max_by(F.struct(F.col(key).alias("k"), F.col("n"), F.col("amount")),
                          F.struct(F.col("n"), F.col("amount"), (-F.col(key)).alias("nk"))).alias("p"))


def peak_window(spark: SparkSession, totals: DataFrame) -> DataFrame:
    """One row per kind (HOUR, DAY): label, key, transactions, amount; a 'no data'
    row when the month has no transfers."""
    # Read twice below; only the hour and day totals (≤ 24 + 31 rows) are
    # needed, so just those are checkpointed, not the per-user rows.
    totals = materialize(totals.where(F.col("level").isin(*TOTAL_LEVELS)))
    hour = _peak_key(totals, "HOUR_TOTAL", "hour").select(F.lit("HOUR").alias("kind"), "p")
    day = _peak_key(totals, "DAY_TOTAL", "day").select(F.lit("DAY").alias("kind"), "p")
    both = hour.unionByName(day)
    label = (F.when(F.col("p.k").isNull(), F.lit(NO_DATA))
             .when(F.col("kind") == "HOUR", S.hour_label(F.col("p.k")))
             .otherwise(S.day_label(F.col("p.k"))))
    return both.select("kind", F.col("p.k").cast("bigint").alias("key"), label.alias("label"),
                       F.coalesce(F.col("p.n"), F.lit(0)).cast("bigint").alias("total_transactions"),
                       F.coalesce(F.col("p.amount"), F.lit(0)).cast("double").alias("total_amount"))


def hourly_chart(spark: SparkSession, totals: DataFrame) -> DataFrame:
    """24 rows, zero-filled, labelled 'HH:00 - HH:59'."""
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    t = totals.where(F.col("level") == "HOUR_TOTAL").select("hour", "n", "amount")
    return (hours.join(t, "hour", "left")
            .select(F.col("hour").cast("bigint").alias("hour"), S.hour_label(F.col("hour")).alias("label"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("total_transactions"),
                    F.coalesce("amount", F.lit(0)).cast("double").alias("total_amount")))


def daily_chart(spark: SparkSession, totals: DataFrame, month: str) -> DataFrame:
    """One row per day of the month, zero-filled, labelled 'Ngày dd'."""
    y, m = (int(x) for x in month.split("-"))
    days = spark.range(1, calendar.monthrange(y, m)[1] + 1).select(F.col("id").cast("int").alias("day"))
    t = totals.where(F.col("level") == "DAY_TOTAL").select("day", "n", "amount")
    return (days.join(t, "day", "left")
            .select(F.col("day").cast("bigint").alias("day"), S.day_label(F.col("day")).alias("label"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("total_transactions"),
                    F.coalesce("amount", F.lit(0)).cast("double").alias("total_amount")))


def fallback_user_name(user_id) -> F.Column:
    uid = user_id.cast("string")
    return (F.when(uid.isNull() | (F.trim(uid) == ""), F.lit("Không rõ người dùng"))
            .otherwise(F.concat(F.lit("User "), F.substring(uid, 1, 8))))


def top_users_peak(spark: SparkSession, fact: DataFrame, month: str, users: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` users in the peak hour and in the peak day (count desc, amount
    desc, user id asc), with the user's name or a fallback label.

    One pass over the transfers: they collapse to (hour, day, account) sums,
    which are stored once. The totals of the hours and days, the peaks, and the
    users inside the peaks all come from these sums. The top-k is a
    TakeOrderedAndProject per kind; names are attached after the limit, so the
    user-dimension join touches at most 2·k rows.
    """
    account = ["owner_user_id", "owner_account_id"]
    sums = materialize(month_rows(fact, month).groupBy(
        F.hour("created_at").alias("hour"), F.dayofmonth("created_at").alias("day"), *account).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")))
    tops = []
    for kind, key in (("HOUR", "hour"), ("DAY", "day")):
        totals = sums.groupBy(key).agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))
        peak_key = _peak_key(totals.withColumn("level", F.lit(kind)), kind, key).select("p.k").scalar()
        tops.append(sums.where(F.col(key) == peak_key).groupBy(F.col(key).alias("key"), *account)
                    .agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))
                    .orderBy(F.desc("n"), F.desc("amount"), F.asc("owner_user_id")).limit(k)
                    .select(F.lit(kind).alias("kind"), F.col("key").cast("bigint").alias("key"), *account, "n", "amount"))
    out = materialize(tops[0].unionByName(tops[1]))  # at most 2·k rows, read twice below
    # At most 2·k ids: broadcasting them filters the user dimension map-side,
    # then the tiny name list is joined back (no shuffle of the user table).
    ids = out.select("owner_user_id").distinct()
    names = (users.select(F.col("user_id").alias("owner_user_id"), "full_name")
             .join(F.broadcast(ids), "owner_user_id"))
    return (out.join(F.broadcast(names), "owner_user_id", "left")
            .select("kind", "key", F.col("owner_user_id").alias("user_id"),
                    F.coalesce("full_name", fallback_user_name(F.col("owner_user_id"))).alias("full_name"),
                    F.col("owner_account_id").alias("account_number"),
                    F.col("n").cast("bigint").alias("total_transactions"),
                    F.col("amount").cast("double").alias("total_amount")))
