"""Settlement, ledger balances, running balances and transfer status.

Settlement rule (per sender, in created_at then id order): a PENDING transfer
whose amount is missing or not above zero FAILS and moves nothing. Any other is
accepted when the sender's balance covers it, and the balance drops by the
amount; a rejected debit leaves the balance untouched (FAILED, no refund). A
credit to an unknown receiver is refunded and the transfer FAILS. Credits of
the same batch become spendable in the next batch.

Scale plan: a sender whose opening balance covers the sum of all its pending
amounts accepts everything, in any order. That is decided from slim rows by one
partial+final aggregate, and the rows then meet their sender's verdict and
their receiver in one join each. Only the remaining ("tight") senders need the
ordered fold; their rows are hash-partitioned by sender, sorted inside each
partition and folded by an Arrow-batched ``mapInPandas`` that streams the
partition (state is one balance per sender; no group is ever materialised in
memory) and passes the rows through, so no decision is joined back. A tight
sender with more than ``hot_senders.HOT_ROWS`` rows is cut into segments first,
whose opening balances come from segment summaries; its segments are then folded
like senders of their own, in many tasks. The flagged rows are checkpointed once
and read by all outcomes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens.operators import hot_senders
from remitlens.schemas import MONEY
from remitlens.session import materialize, range_count

# Rows of tight senders go through the fold with their own columns, so the
# decision never has to be joined back to the transfers.
FOLD_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.LongType()),
    T.StructField("from_id", T.LongType()),
    T.StructField("to_id", T.LongType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("to_known", T.BooleanType()),
    T.StructField("amount_c", T.LongType()),
    T.StructField("accepted", T.BooleanType()),
])


def _fold_rows(amt: np.ndarray, known: np.ndarray, bal: int, ok: np.ndarray) -> int:
    """Fold one sender's rows (already in order) from balance ``bal``; marks the
    accepted rows in ``ok`` and returns the closing balance.

    Runs instead of single rows: in a window, the cumulative debit before each
    row gives every row's balance if all earlier rows of the run were accepted,
    so the first row that does not fit ends the accepted run; the rows the
    unchanged balance cannot cover form the rejected run that follows. The
    window doubles while whole windows are consumed. When runs alternate
    quickly, a short plain loop is cheaper and takes over for a while.
    """
    m, j, w, burst = len(amt), 0, 64, 256
    while j < m:
        begin, e = j, min(m, j + w)
        d = np.where(known[j:e], amt[j:e], 0)
        c = np.cumsum(d)
        fits = (bal - (c - d)) >= amt[j:e]
        f = e - j if fits.all() else int(np.argmin(fits))
        if f:
            ok[j:j + f] = True
            bal -= int(c[f - 1])
            j += f
        if j < e:
            short = amt[j:e] > bal
            j += e - j if short.all() else int(np.argmin(short))
        if j == e:
            w *= 2
            continue
        w = 64
        if j - begin >= 8:
            burst = 256
            continue
        stop = min(m, j + burst)
        accepted = []
        for a, k in zip(amt[j:stop].tolist(), known[j:stop].tolist()):
            accepted.append(bal >= a)
            if bal >= a and k:
                bal -= a
        ok[j:stop] = accepted
        j, burst = stop, min(burst * 2, 8192)
    return bal


def _folded(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Streaming fold over rows sorted by (from_id, _pid, created_at,
    transaction_id): (batch, accepted, closing balances of the (from_id, _pid)
    units that a batch leaves behind).

    Amounts and balances are integer cents (exact). State crosses Arrow batch
    boundaries: only the current unit's balance is kept. A transfer to an
    unknown receiver is debited and refunded, so it never moves the balance.
    """
    cur, bal = None, 0
    for pdf in batches:
        n, closed = len(pdf), []
        ids, pids = pdf["from_id"].to_numpy(), pdf["_pid"].to_numpy()
        amt = pdf["amount_c"].to_numpy(dtype=np.int64)
        opening = pdf["opening_c"].to_numpy(dtype=np.int64)
        known = pdf["to_known"].to_numpy(dtype=bool)
        ok = np.zeros(n, dtype=bool)
        if n:
            starts = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (pids[1:] != pids[:-1])]).tolist() + [n]
            for s, e in zip(starts[:-1], starts[1:]):
                if (ids[s], pids[s]) != cur:
                    if cur is not None:
                        closed.append((*cur, bal))
                    cur, bal = (ids[s], pids[s]), int(opening[s])
                bal = _fold_rows(amt[s:e], known[s:e], bal, ok[s:e])
        yield pdf, ok, closed
    if cur is not None:
        yield None, None, [(*cur, bal)]


def _fold_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf, ok, _ in _folded(batches):
        if pdf is not None:
            yield pdf[["transaction_id", "from_id", "to_id", "created_at", "to_known", "amount_c"]].assign(accepted=ok)


def _closing_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for _, _, closed in _folded(batches):
        if closed:
            yield pd.DataFrame(closed, columns=["from_id", "_pid", "closing"])


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.repartition("from_id", "_pid").sortWithinPartitions("from_id", "_pid", "created_at", "transaction_id")


def _closing(rows: DataFrame) -> DataFrame:
    """(from_id, _pid, closing): the balance that each unit ends with."""
    return _in_order(rows).mapInPandas(_closing_partition, "from_id bigint, _pid int, closing bigint")


def settle_batch(transfers: DataFrame, accounts: DataFrame) -> DataFrame:
    """PENDING transfers → transaction_id, from_id, to_id, amount, created_at,
    status (SUCCESS / FAILED), reason."""
    pend = transfers.where(F.col("status") == "PENDING").select(
        "transaction_id", "from_id", "to_id", "amount", "created_at")
    valid = F.coalesce(F.col("amount") > 0, F.lit(False))
    # What a sender's valid debits need at most; a hot sender collapses map-side.
    need = pend.where(valid).groupBy("from_id").agg(F.sum("amount").alias("_need"), F.count(F.lit(1)).alias("_rows"))
    senders = (accounts.select(F.col("account_id").alias("from_id"), F.col("balance").alias("opening"))
               .join(need, "from_id")
               .withColumn("_safe", F.col("opening") >= F.col("_need"))
               .withColumn("_hot", F.col("_rows") > hot_senders.HOT_ROWS).drop("_need", "_rows"))
    receivers = accounts.select(F.col("account_id").alias("to_id"), F.lit(True).alias("_known"))
    # Every outcome below reads ``flagged``: a reliable checkpoint in the shared
    # folder computes the joins once and keeps them after an executor loss.
    flagged = materialize(
        pend.withColumn("valid", valid).join(receivers, "to_id", "left").join(senders, "from_id", "left")
        .select("transaction_id", "from_id", "to_id", "amount", "created_at", "valid",
                F.col("_known").isNotNull().alias("to_known"), "opening", "_safe", "_hot"))

    cols = ["transaction_id", "from_id", "to_id", "amount", "created_at", "valid", "to_known"]
    ordered = F.col("valid") & F.col("opening").isNotNull() & ~F.coalesce(F.col("_safe"), F.lit(False))
    plain = flagged.where(~ordered).select(*cols, (F.col("valid") & F.col("opening").isNotNull()).alias("accepted"))
    slim = ["transaction_id", "from_id", "to_id", "created_at", "to_known",
            (F.col("amount") * 100).cast("long").alias("amount_c"), (F.col("opening") * 100).cast("long").alias("opening_c")]
    tight = flagged.where(ordered & ~F.col("_hot")).select(*slim, F.lit(0).alias("_pid"))
    hot = flagged.where(ordered & F.col("_hot")).select(*slim)
    if not hot.isEmpty():
        hot = hot_senders.in_segments(hot, hot_senders.SEGMENT_ROWS)
        tight = tight.unionByName(hot_senders.with_opening(hot, hot_senders.opening_balances(hot, _closing)))
    folded = _in_order(tight).mapInPandas(_fold_partition, FOLD_SCHEMA).select(
        "transaction_id", "from_id", "to_id",
        (F.col("amount_c").cast(T.DecimalType(18, 0)) * F.lit(0.01).cast(MONEY)).cast(MONEY).alias("amount"),
        "created_at", F.lit(True).alias("valid"), "to_known", "accepted")
    out = plain.unionByName(folded)

    reason = (F.when(~F.col("valid"), F.lit("INVALID_AMOUNT"))
              .when(~F.col("accepted"), F.lit("INSUFFICIENT_BALANCE"))
              .when(~F.col("to_known"), F.lit("RECEIVER_NOT_FOUND")))
    status = F.when(reason.isNull(), F.lit("SUCCESS")).otherwise(F.lit("FAILED"))
    return out.select("transaction_id", "from_id", "to_id", "amount", "created_at",
                      status.alias("status"), reason.alias("reason"))


def ledger_movements(settled: DataFrame) -> DataFrame:
    """±amount rows: debit (``side`` 0) of the sender and credit (1) of the receiver
    for SUCCESS transfers (a refunded debit nets to zero and is left out)."""
    ok = settled.where(F.col("status") == "SUCCESS")
    moves = F.array(
        F.struct(F.col("from_id").alias("account_id"), F.lit(0).alias("side"), (-F.col("amount")).alias("delta")),
        F.struct(F.col("to_id").alias("account_id"), F.lit(1).alias("side"), F.col("amount").alias("delta")))
    return ok.select("transaction_id", "created_at", F.explode(moves).alias("m")).select(
        "transaction_id", "created_at", "m.account_id", "m.side", F.col("m.delta").cast(MONEY).alias("delta"))


def ledger_balance(accounts: DataFrame, movements: DataFrame) -> DataFrame:
    """Opening balance + sum of movements per account (partial aggregation of
    the movements before the shuffle; accounts without movements keep theirs)."""
    net = movements.groupBy("account_id").agg(F.sum("delta").alias("_net"))
    return (accounts.select("account_id", F.col("balance").alias("opening"))
            .join(net, "account_id", "left")
            .select("account_id", "opening",
                    (F.col("opening") + F.coalesce(F.col("_net"), F.lit(0))).cast(T.DecimalType(20, 2))
                    .alias("balance")))


def running_sum_global(df: DataFrame, key: str, order_cols: list[str], value: str, out: str) -> DataFrame:
    """Cumulative ``value`` per ``key`` in ``order_cols`` order, skew-safe.

    Rows are range-partitioned on (key, order...), so a hot key's history is
    spread over several consecutive ranges. Inside a range the running sum is
    a window over (range, key). Only the *first* key of a range can continue
    from earlier ranges, so the carry-in is one value per range: the summed
    tails of the preceding ranges that end with that key. That table has at
    most one row per range partition (bounded by ``spark.sql.shuffle.partitions``)
    and is broadcast, so the only shuffle of the rows is the window's.
    The input is stored first (range partitioning samples it, and its cause may
    be costly), and the ranged frame too, so every read sees the same
    partitioning, also after an executor loss.
    """
    df = materialize(df)
    n_parts = range_count(df)
    k = F.col(key)
    ranged = (df.repartitionByRange(n_parts, k.asc_nulls_first(), *order_cols)
              .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))
    # First and last key of each non-empty range (nulls sort first).
    bounds = ranged.groupBy("_pid").agg(
        F.when(F.count_if(k.isNull()) > 0, F.lit(None)).otherwise(F.min(k)).alias("_first"),
        F.max(k).alias("_last"))
    tails = (ranged.join(F.broadcast(bounds), "_pid").where(k.eqNullSafe(F.col("_last")))
             .groupBy("_pid", "_first", "_last").agg(F.sum(value).alias("_tail")))
    # ≤ n_parts rows from here on: running tail per last key, then the carry of
    # the previous non-empty range when it ends with this range's first key.
    same_last = Window.partitionBy("_last").orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    by_range = Window.orderBy("_pid")
    carried = (tails.withColumn("_cum", F.sum("_tail").over(same_last))
               .withColumn("_prev_last", F.lag("_last").over(by_range))
               .withColumn("_prev_cum", F.lag("_cum").over(by_range)))
    offsets = carried.select(
        "_pid", "_first",
        F.when(F.col("_prev_last").eqNullSafe(F.col("_first")) & F.col("_prev_cum").isNotNull(),
               F.col("_prev_cum")).alias("_off"))
    w = Window.partitionBy("_pid", key).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    carry = F.when(k.eqNullSafe(F.col("_first")), F.coalesce(F.col("_off"), F.lit(0))).otherwise(F.lit(0))
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(out, carry + F.sum(value).over(w))
            .drop("_pid", "_first", "_off"))


def running_balance(accounts: DataFrame, movements: DataFrame) -> DataFrame:
    """Balance after each ledger movement: opening + cumulative deltas in
    (created_at, transaction_id, side) order per account: a transfer to the own
    account debits before it credits."""
    cum = running_sum_global(movements, "account_id", ["created_at", "transaction_id", "side"], "delta", "_cum")
    opening = accounts.select("account_id", F.col("balance").alias("opening"))
    return (cum.join(opening, "account_id", "left")
            .select("account_id", "transaction_id", "created_at", "side", "delta",
                    (F.coalesce(F.col("opening"), F.lit(0)) + F.col("_cum")).cast(T.DecimalType(20, 2))
                    .alias("balance_after")))


STATUSES = ["PENDING", "PROCESSING", "SUCCESS", "FAILED"]


def latest_status(status_events: DataFrame) -> DataFrame:
    """Current status per transfer from status-change events (PENDING →
    PROCESSING → SUCCESS/FAILED): the event with the largest (event_ts, seq).

    Time, sequence (0-7) and the status' place in ``STATUSES`` are packed into
    one long, so the maximum is a hash aggregate with fixed-width buffers and a
    map-side step. A status outside the list reads as NULL."""
    code = F.array_position(F.array(*[F.lit(x) for x in STATUSES]), F.col("status"))
    packed = F.unix_micros(F.col("event_ts").cast("timestamp")) * 64 + F.col("seq") * 8 + F.coalesce(code, F.lit(0))
    latest = status_events.groupBy("transaction_id").agg(F.max(packed).alias("_p"), F.max("event_ts").alias("updated_at"))
    return latest.select("transaction_id", F.get(F.array(*[F.lit(x) for x in STATUSES]),
                                                 (F.pmod("_p", F.lit(8)) - 1).cast("int")).alias("status"), "updated_at")


def status_events(settled: DataFrame) -> DataFrame:
    """The life cycle of each settled transfer as events: PENDING at creation,
    PROCESSING, then the outcome."""
    ev = F.array(
        F.struct(F.lit("PENDING").alias("status"), F.lit(0).alias("seq")),
        F.struct(F.lit("PROCESSING").alias("status"), F.lit(1).alias("seq")),
        F.struct(F.col("status").alias("status"), F.lit(2).alias("seq")))
    return settled.select("transaction_id", "created_at", F.explode(ev).alias("e")).select(
        "transaction_id", F.col("e.status").alias("status"), F.col("e.seq").alias("seq"),
        F.col("created_at").alias("event_ts"))
