"""Transaction density per province (count of fact rows, both directions)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlens.functions import scalars as S


def province_density(fact: DataFrame) -> DataFrame:
    """province (blank → UNKNOWN), n rows — partial+final hash aggregate."""
    return (fact.groupBy(S.blank_to(F.col("province"), S.UNKNOWN).alias("province"))
            .agg(F.count(F.lit(1)).alias("n")))


def density_rank(density: DataFrame) -> DataFrame:
    """Position 1..n after a descending sort (ties by province).

    The input is the aggregated result (one row per province), so an
    un-partitioned window here orders at most #provinces rows.
    """
    w = Window.orderBy(F.desc("n"), F.asc("province"))
    return density.select("province", F.col("n").cast("bigint").alias("n"),
                          F.row_number().over(w).cast("bigint").alias("rank"))


def density_share(density: DataFrame) -> DataFrame:
    """Each province's count as % of the largest (dashboard bar width)."""
    w = Window.partitionBy()
    return density.select("province", F.col("n").cast("bigint").alias("n"),
                          F.round(F.col("n") * 100.0 / F.max("n").over(w), 2).alias("pct_of_max"))
