"""District risk: totals, failures, reversals, large-value, rapid-fire and fan-out patterns.

Every measure is an aggregate keyed by district. The single measures are
available one by one (two-level aggregates where a bucket threshold applies);
the full report (``district_measures``) computes all six from one scan and one
wide shuffle, rolled up inside its partitions. No join, no global window.

After ``strict_times`` the pattern measures take only times that the strict
rule parses (``created_at_raw``, as the text store's scan keeps it).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlens.functions import scalars as S

# Fixed values of the rules.
LARGE_AMOUNT_THRESHOLD = 500_000_000
LARGE_AMOUNT_MIN_PER_HOUR = 3
RAPID_FIRE_MIN_PER_MINUTE = 2

MEASURES = ["total", "failed", "reversed", "large_amount", "rapid_fire", "fan_out"]


def quarter_bounds(year: int, quarter: str):
    q = int(str(quarter).strip().upper().lstrip("Q"))
    start = dt.datetime(year, 3 * (q - 1) + 1, 1)
    end = dt.datetime(year + 1, 1, 1) if q == 4 else dt.datetime(year, 3 * q + 1, 1)
    return start, end


def quarter_slice(fact: DataFrame, year: int, quarter: str) -> DataFrame:
    """Rows of one year+quarter.

    On the partitioned store the year/quarter predicate prunes directories. The
    same slice is also stated as a literal range on created_at (rows without a
    parsable time are kept, as the reference counts them), which Parquet can
    evaluate against row-group statistics when the fact is derived from raw
    transfer tables.
    """
    start, end = quarter_bounds(year, quarter)
    ts = F.col("created_at")
    return fact.where((F.col("year") == year) & (F.col("quarter") == quarter)
                      & (ts.isNull() | ((ts >= F.lit(start)) & (ts < F.lit(end)))))


def strict_times(fact: DataFrame) -> DataFrame:
    """The rows of a text store with ``created_at`` read by the strict rule: a
    time in any other form becomes NULL, so the row counts in totals only."""
    return fact.withColumn("created_at", S.ts_parse(F.col("created_at_raw"), strict=True))


def _prepared(fact: DataFrame) -> DataFrame:
    return fact.select(
        S.blank_to(F.col("district"), S.UNKNOWN).alias("district"),
        S.status_norm(F.col("status")).alias("st"),
        F.upper(S.java_trim(F.col("direction"))).alias("dir"),
        S.java_trim(F.col("owner_account_id").cast("string")).alias("account"),
        S.java_trim(F.col("counterparty_account_id").cast("string")).alias("counterparty"),
        "amount", "created_at",
    ).where(F.col("amount").isNotNull())


def district_counts(fact: DataFrame) -> DataFrame:
    """district, total, failed (FAILED or REVERSED), reversed."""
    p = _prepared(fact)
    return p.groupBy("district").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("st").isin("FAILED", "REVERSED")).alias("failed"),
        F.count_if(F.col("st") == "REVERSED").alias("reversed"))


def large_amount(fact: DataFrame, threshold=LARGE_AMOUNT_THRESHOLD,
                 min_per_hour: int = LARGE_AMOUNT_MIN_PER_HOUR) -> DataFrame:
    """OUT rows ≥ threshold per (district, account, clock hour); buckets with at
    least ``min_per_hour`` rows contribute their row count to the district."""
    p = _prepared(fact).where((F.col("dir") == "OUT") & (F.col("amount") >= F.lit(threshold))
                              & F.col("created_at").isNotNull())
    buckets = p.groupBy("district", "account", F.date_trunc("hour", "created_at").alias("h")).count()
    return (buckets.where(F.col("count") >= min_per_hour)
            .groupBy("district").agg(F.sum("count").alias("large_amount")))


def rapid_fire(fact: DataFrame, min_per_minute: int = RAPID_FIRE_MIN_PER_MINUTE) -> DataFrame:
    """OUT rows per (district, account, clock minute); buckets ≥ min contribute their count."""
    p = _prepared(fact).where((F.col("dir") == "OUT") & F.col("created_at").isNotNull())
    buckets = p.groupBy("district", "account", F.date_trunc("minute", "created_at").alias("m")).count()
    return (buckets.where(F.col("count") >= min_per_minute)
            .groupBy("district").agg(F.sum("count").alias("rapid_fire")))


def fan_out(fact: DataFrame, min_counterparties: int | None = None, approximate: bool = False,
            rsd: float = 0.01) -> DataFrame:
    """Distinct (account, clock hour, counterparty) OUT combinations per district.

    Two-level distinct: the first aggregate removes duplicates map-side and
    shuffles on the full combination, so a hot district is spread over many
    tasks; the second counts per district. ``min_counterparties`` optionally
    keeps only (account, hour) buckets reaching that many counterparties (the
    reference defines such a threshold but does not apply it). ``approximate``
    counts with HyperLogLog sketches instead (for very large inputs).
    """
    if approximate and min_counterparties is not None:
        raise ValueError("the approximate count has no counterparty threshold")
    p = _prepared(fact).where((F.col("dir") == "OUT") & F.col("created_at").isNotNull())
    if approximate:
        # One aggregate of HyperLogLog sketches per district (relative error
        # about ``rsd``): no shuffle of the distinct combinations.
        combo = F.struct("account", F.date_trunc("hour", "created_at").alias("h"), "counterparty")
        return p.groupBy("district").agg(F.approx_count_distinct(combo, rsd).alias("fan_out"))
    combos = p.select("district", "account", F.date_trunc("hour", "created_at").alias("h"),
                      "counterparty").distinct()
    if min_counterparties is not None:
        per_bucket = combos.groupBy("district", "account", "h").count()
        return (per_bucket.where(F.col("count") >= min_counterparties)
                .groupBy("district").agg(F.sum("count").alias("fan_out")))
    return combos.groupBy("district").agg(F.count(F.lit(1)).alias("fan_out"))


def district_measures(fact: DataFrame, large_threshold=LARGE_AMOUNT_THRESHOLD,
                      large_min_per_hour: int = LARGE_AMOUNT_MIN_PER_HOUR,
                      rapid_min_per_minute: int = RAPID_FIRE_MIN_PER_MINUTE) -> DataFrame:
    """All six measures from one scan and one wide shuffle of narrow rows.

    Rows are dealt by (district, account, hour), so a hot district or account
    spreads. Everything below rolls up inside these partitions: the combinations
    of minute and counterparty, each minute's total, each counterparty's first
    row of the hour, then the account's hour. Only one small row per district
    and task is shuffled again.
    """
    p = _prepared(fact)
    out = (F.col("dir") == "OUT") & F.col("created_at").isNotNull()
    hour = ["district", "account", "h"]
    rows = p.select(
        "district", "account", F.date_trunc("hour", "created_at").alias("h"),
        F.date_trunc("minute", "created_at").alias("m"), F.when(out, F.col("counterparty")).alias("cp"),
        F.col("st").isin("FAILED", "REVERSED").alias("is_f"), (F.col("st") == "REVERSED").alias("is_r"),
        out.alias("is_out"), (out & (F.col("amount") >= F.lit(large_threshold))).alias("is_l")).repartition(*hour)
    combos = rows.groupBy(*hour, "m", "is_out", "cp").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_f").alias("f"), F.count_if("is_r").alias("r"),
        F.count_if("is_l").alias("l"))
    minute = Window.partitionBy(*hour, "m", "is_out")
    other = Window.partitionBy(*hour, "is_out", "cp").orderBy("m")
    combos = combos.withColumns({"in_minute": F.sum("n").over(minute), "turn": F.row_number().over(other)})
    hours = combos.groupBy(*hour).agg(
        F.sum("n").alias("n"), F.sum("f").alias("f"), F.sum("r").alias("r"), F.sum("l").alias("l"),
        F.sum(F.when(F.col("is_out") & (F.col("in_minute") >= rapid_min_per_minute), F.col("n"))).alias("rapid"),
        F.count_if(F.col("is_out") & (F.col("turn") == 1)).alias("fan"))
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return hours.groupBy("district").agg(
        whole("n").alias("total"), whole("f").alias("failed"), whole("r").alias("reversed"),
        whole(F.when(F.col("l") >= large_min_per_hour, F.col("l"))).alias("large_amount"),
        whole("rapid").alias("rapid_fire"), whole("fan").alias("fan_out"))


def district_risk(fact: DataFrame, **kw) -> DataFrame:
    """The six measures, fail/reversal rates (2 decimals, half-up) and risk level,
    ordered CAO → TRUNG_BINH → THAP, then fail rate desc, then district."""
    m = district_measures(fact, **kw)
    fail_rate = S.pct2_java(F.col("failed"), F.col("total"))
    rev_rate = S.pct2_java(F.col("reversed"), F.col("total"))
    out = m.select("district", *MEASURES,
                   fail_rate.alias("fail_rate"), rev_rate.alias("reversal_rate"))
    out = out.withColumn("risk_level", S.risk_level(F.col("fail_rate"), F.col("reversal_rate"),
                                                    F.col("rapid_fire"), F.col("fan_out"),
                                                    F.col("large_amount")))
    return out.orderBy(S.risk_score(F.col("risk_level")).desc(), F.desc("fail_rate"), "district")


def district_cards(risk: DataFrame) -> DataFrame:
    """Dashboard cards over the (small) risk result: district count, total
    transactions, and the worst district (first in risk order)."""
    ranked = risk.select("district", "total", S.risk_score(F.col("risk_level")).alias("s"), "fail_rate")
    worst = F.min_by("district", F.struct((-F.col("s")).alias("a"), (-F.col("fail_rate")).alias("b"),
                                          F.col("district").alias("c")))
    return ranked.agg(F.count(F.lit(1)).cast("bigint").alias("district_count"),
                      F.sum("total").cast("bigint").alias("total_transactions"),
                      worst.alias("worst_district"))
