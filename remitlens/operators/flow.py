"""Province-to-province money flow (self-join of fact sides, sum, top-N)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlens.operators.facts import flow_join


def province_flow(fact: DataFrame, top_n: int = 5) -> DataFrame:
    """Sum of OUT amounts per (from province, to province), the ``top_n`` largest.

    ``top_n <= 0`` yields an empty result. Ties break on the province pair, so
    the top-N is deterministic; ``orderBy().limit()`` plans as
    TakeOrderedAndProject (per-partition top-N, no global sort).
    """
    flows = (flow_join(fact)
             .groupBy("from_province", "to_province")
             .agg(F.sum("amount").alias("total")))
    ranked = flows.orderBy(F.desc("total"), "from_province", "to_province")
    limited = ranked.limit(max(top_n, 0))
    return limited.select("from_province", "to_province", F.col("total").cast("double").alias("total"))


def flow_share(flows: DataFrame) -> DataFrame:
    """Each flow as % of the largest flow and of the grand total (small input only)."""
    w = Window.partitionBy()
    return flows.select(
        "*",
        F.round(F.col("total") * 100.0 / F.max("total").over(w), 2).alias("pct_of_max"),
        F.round(F.col("total") * 100.0 / F.sum("total").over(w), 2).alias("pct_of_total"),
    )
