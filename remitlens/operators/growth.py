"""Quarterly statistics and Q1 → Q2 growth."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.functions import scalars as S


def quarter_stats(fact: DataFrame, year: int, quarters=("Q1", "Q2"), direction: str | None = None) -> DataFrame:
    """Per quarter of ``year``: total amount, row count, SUCCESS count
    (case-insensitive), fail count and success rate (2 decimals, half-up).

    Like the reference, both fact sides are counted unless ``direction`` is
    given, quarter '1'/'2' is read as Q1/Q2, and rows with an empty status are
    left out.
    """
    q = F.upper(S.java_trim(F.col("quarter")))
    q = F.when(q == "1", "Q1").when(q == "2", "Q2").otherwise(q)
    # The stored year is derived from created_at, so the year is also stated
    # as a literal created_at range (rows without a parsable time are kept):
    # scans of raw transfer tables can then skip row groups of other years.
    ts = F.col("created_at")
    in_year = ts.isNull() | ((ts >= F.lit(dt.datetime(year, 1, 1))) & (ts < F.lit(dt.datetime(year + 1, 1, 1))))
    rows = fact.where((S.java_trim(F.col("year").cast("string")) == str(year)) & in_year
                      & F.col("amount").isNotNull()
                      & F.col("status").isNotNull() & (F.col("status") != ""))
    if direction:
        rows = rows.where(F.upper(F.col("direction")) == direction.upper())
    rows = rows.select(q.alias("quarter"), "amount", "status").where(F.col("quarter").isin(*quarters))
    agg = rows.groupBy("quarter").agg(
        F.sum("amount").alias("total_amount"),
        F.count(F.lit(1)).alias("tx_count"),
        F.count_if(F.upper(F.col("status")) == "SUCCESS").alias("success_count"))
    return agg.select(
        F.lit(year).cast("bigint").alias("year"), "quarter",
        F.col("total_amount").cast("double").alias("total_amount"),
        F.col("tx_count").cast("bigint").alias("tx_count"),
        F.col("success_count").cast("bigint").alias("success_count"),
        (F.col("tx_count") - F.col("success_count")).cast("bigint").alias("fail_count"),
        S.round2_java(F.col("success_count").cast("double") * 100.0 / F.col("tx_count")).alias("success_rate"))


def quarter_growth(stats: DataFrame) -> DataFrame:
    """% growth Q1 → Q2 of amount and count (2 decimals, half-up; 0 when the
    base is 0); no row unless both quarters exist. Pivot over the ≤ 2-row input."""
    p = (stats.groupBy("year").pivot("quarter", ["Q1", "Q2"])
         .agg(F.first("total_amount").alias("amt"), F.first("tx_count").alias("cnt")))
    a1, a2, c1, c2 = F.col("Q1_amt"), F.col("Q2_amt"), F.col("Q1_cnt").cast("double"), F.col("Q2_cnt").cast("double")
    return (p.where(a1.isNotNull() & a2.isNotNull())
            .select("year",
                    F.when(a1 > 0, S.round2_java((a2 - a1) / a1 * 100)).otherwise(F.lit(0.0))
                    .alias("growth_amount_pct"),
                    F.when(c1 > 0, S.round2_java((c2 - c1) / c1 * 100)).otherwise(F.lit(0.0))
                    .alias("growth_count_pct")))
