"""Global ranking without funnelling every row into one partition.

``Window.orderBy(x)`` with no ``partitionBy`` moves the whole input into a
single task. ``percent_rank_global`` ranks the *distinct values* instead:

    pct_rank(x) = (rows with a value smaller than x) / (N − 1)

1. rows → (value, count): a partial+final aggregate, so a value shared by a
   third of all rows collapses map-side into one row;
2. the distinct values are range-partitioned (each value occurs once, so the
   ranges are even), per-range totals become offsets (at most
   ``#partitions`` rows, broadcast), and the count of smaller rows is finished
   inside each range;
3. every row gets its value's count by an equi-join on the value (null-safe);
   AQE splits a hot value's partition on the row side.

The input rows and the range-partitioned value table are checkpointed
(reliable checkpoints in the shared ``spark.checkpoint.dir``): each is read
twice, and the range bounds come from sampling, so both reads must see the same
partition assignment, also after an executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlens.session import materialize, range_count


def percent_rank_global(df: DataFrame, col: str, partitions: int | None = None) -> DataFrame:
    """Adds ``pct_rank`` = (rank − 1) / (N − 1) over ascending ``col``, nulls
    first like ``percent_rank()`` (0 when N = 1)."""
    # The rows are read twice (value counts, join back): compute them once.
    df = materialize(df)
    n_parts = partitions or range_count(df)
    values = df.groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    ranged = (values.repartitionByRange(n_parts, F.col("_v").asc_nulls_first())
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    per_range = ranged.groupBy("_pid").agg(F.sum("_c").alias("_pc"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        "_pid",
        F.coalesce(F.sum("_pc").over(before), F.lit(0)).alias("_before"),
        F.sum("_pc").over(Window.partitionBy()).alias("_n"))
    # offsets has one row per range partition: bounded by n_parts.
    inside = (Window.partitionBy("_pid").orderBy(F.col("_v").asc_nulls_first())
              .rowsBetween(Window.unboundedPreceding, -1))
    less = F.col("_before") + F.coalesce(F.sum("_c").over(inside), F.lit(0))
    ranks = ranged.join(F.broadcast(offsets), "_pid").select("_v", less.alias("_less"), "_n")
    pct = F.when(F.col("_n") > 1, F.col("_less") / (F.col("_n") - 1)).otherwise(F.lit(0.0))
    return (df.join(ranks, df[col].eqNullSafe(ranks["_v"]))
            .withColumn("pct_rank", pct.cast("double"))
            .drop("_v", "_less", "_n"))
