"""Settlement of senders with very many transfers, in parallel and exact.

A sender's balance only falls inside a batch, and what a transfer does depends
on the balance it meets. So the history of a hot sender is cut into segments,
and what is missing is the balance at the start of each segment; with it, all
segments are folded at the same time.

The balances are found in rounds by halving. With a balance b between 2^k and
2^(k+1), every amount below 2^k fits for as long as the balance stays at 2^k or
above, and the first accepted amount of 2^k or more takes it below. Until then
the balance is b less the running sum of the small amounts, which segment
summaries (sum and least amount by power of two) give without reading a row.
The segment where the balance falls below 2^k is the first one whose small
amounts do that, or one where a large amount may fit; these few are folded, all
at once, and the first that leaves the expected path ends the round with its
exact closing balance. Each round lowers k, so there are at most as many rounds
as the largest balance has bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.session import materialize

HOT_ROWS = 1_000_000      # a sender with more pending transfers is settled by segments
SEGMENT_ROWS = 100_000
_UNIT = ["from_id", "_pid"]


def _power(value: Column) -> Column:
    """k with 2^k <= value < 2^(k+1), exact for every positive long; 0 for 0."""
    return F.length(F.bin(value)) - 1


def in_segments(rows: DataFrame, segment_rows: int) -> DataFrame:
    """The rows in ranges of (from_id, created_at, transaction_id); a sender's
    rows of range ``_pid`` are one segment."""
    parts = max(1, -(-rows.count() // segment_rows))
    return materialize(rows.repartitionByRange(parts, "from_id", "created_at", "transaction_id")
                       .withColumn("_pid", F.spark_partition_id()))


def with_opening(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """The rows of the segments in ``starts``, each with its segment's start as ``opening_c``."""
    return rows.drop("opening_c").join(starts.select(*_UNIT, F.col("start").alias("opening_c")), _UNIT)


def opening_balances(rows: DataFrame, fold: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(from_id, _pid, start): the balance that each segment of ``rows`` (from
    ``in_segments``) begins with. ``fold`` folds segments with a given ``opening_c``
    one by one and returns (from_id, _pid, closing)."""
    moved = F.when(F.col("to_known"), F.col("amount_c"))
    summary = materialize(rows.groupBy(*_UNIT, _power(F.col("amount_c")).alias("k")).agg(
        F.coalesce(F.sum(moved), F.lit(0)).alias("sum"), F.min(moved).alias("least")))
    open_ = rows.groupBy("from_id").agg(F.min("opening_c").alias("b"), F.lit(-1).alias("done"))
    found = []
    before = Window.partitionBy("from_id").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    sender = Window.partitionBy("from_id")
    while True:
        open_ = materialize(open_)
        if open_.isEmpty():
            break
        # one row a segment from here on
        power, expected = _power(F.col("b")), F.col("start") - F.col("small")
        least = F.expr("shiftleft(1L, kb)")
        path = (summary.join(open_, "from_id").where("_pid > done")
                .groupBy(*_UNIT, "b", power.alias("kb")).agg(
                    F.coalesce(F.sum(F.when(F.col("k") < power, F.col("sum"))), F.lit(0)).alias("small"),
                    F.min(F.when(F.col("k") == power, F.col("least"))).alias("large"))
                .withColumn("start", F.col("b") - F.coalesce(F.sum("small").over(before), F.lit(0)))
                .withColumn("falls", (F.col("b") > 0) & (expected < least))
                .withColumn("end", F.min(F.when(F.col("falls"), F.col("_pid"))).over(sender))
                .where("end IS NULL OR _pid <= end"))
        path = materialize(path.withColumn("tried", F.col("falls") | F.coalesce(F.col("large") <= F.col("start"), F.lit(False))))
        closing = fold(with_opening(rows, path.where("tried")))
        left = path.where("tried").join(closing, _UNIT).where(F.col("falls") | (F.col("closing") != expected))
        event = materialize(left.groupBy("from_id").agg(F.min("_pid").alias("at"), F.min_by("closing", "_pid").alias("closing")))
        found.append(materialize(path.join(event, "from_id", "left").where("at IS NULL OR _pid <= at").select(*_UNIT, "start")))
        open_ = event.select("from_id", F.col("closing").alias("b"), F.col("at").alias("done"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
