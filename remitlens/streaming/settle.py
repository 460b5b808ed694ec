"""Settlement in the stream: keyed state for ids, folded net movements for balances.

A transfer id is decided once, for ever: a stateful de-duplication keeps the ids
(RocksDB: a micro-batch looks up only its own ids, and the state lies on disk,
hashed over the state partitions). Balances are the accounts plus the net
movements so far. Movements of a micro-batch go to its own folder; after every
``fold_every`` batches an epoch ends and its movements are folded into one row
for each account, so a micro-batch reads the accounts, one folded table and
fewer than ``fold_every`` small folders, however long the stream has run. No
earlier decision is read again.

Everything that a batch writes lies in its own folder and is written anew when
the batch is repeated after a failure; the id state of the failed attempt is
dropped by the stream's checkpoint with it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.operators import ledger
from remitlens.schemas import MONEY
from remitlens.session import materialize, remove_path

DECISIONS = (f"transaction_id bigint, from_id bigint, to_id bigint, amount {MONEY.simpleString()}, "
             "created_at timestamp_ntz, status string, reason string")
NET = "account_id bigint, delta decimal(28,2)"
FOLD_EVERY = 32


def pending_transfers(events: DataFrame) -> DataFrame:
    """PENDING transfer events in the columns of the batch settlement."""
    return events.where(F.col("status") == "PENDING").select(
        F.col("transactionId").cast("long").alias("transaction_id"),
        F.col("fromAccountId").cast("long").alias("from_id"),
        F.col("toAccountId").cast("long").alias("to_id"), "amount", "status",
        F.to_timestamp_ntz(F.date_format(F.col("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("created_at"))


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows under ``path``; none where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _summed(net: DataFrame) -> DataFrame:
    return net.groupBy("account_id").agg(F.sum("delta").cast("decimal(28,2)").alias("delta"))


def net_before(spark: SparkSession, store: str, batch_id: int, fold_every: int = FOLD_EVERY) -> DataFrame:
    """Net movement of each account from all batches before ``batch_id``: the
    fold of the finished epochs and the batches of this one."""
    epoch = batch_id // fold_every
    recent = _stored(spark, f"{store}/net/epoch={epoch}", NET + ", batch bigint")
    folded = _stored(spark, f"{store}/folded/epoch={epoch}", NET)
    return _summed(recent.where(F.col("batch") < batch_id).drop("batch").unionByName(folded))


def fold_epoch(spark: SparkSession, store: str, epoch: int, fold_every: int = FOLD_EVERY) -> None:
    """Fold the movements of the epoch before ``epoch`` into one row an account.
    What no repeated batch can need any more (two epochs back) is removed."""
    total = net_before(spark, store, epoch * fold_every - 1, fold_every)
    last = _stored(spark, f"{store}/net/epoch={epoch - 1}", NET + ", batch bigint")
    last = last.where(F.col("batch") == epoch * fold_every - 1).drop("batch")
    _summed(total.unionByName(last)).write.mode("overwrite").parquet(f"{store}/folded/epoch={epoch}")
    for name in ("net", "folded"):
        remove_path(spark, f"{store}/{name}/epoch={epoch - 2}")


def settle_micro_batch(pending: DataFrame, accounts: DataFrame, store: str, batch_id: int,
                       fold_every: int = FOLD_EVERY) -> None:
    """Settle one micro-batch of new ids against the ledger in ``store`` and add
    its decisions. Ids that earlier batches decided must have been left out
    (``stream_settle`` does); an id that this batch repeats is decided once.
    Credits are spendable from the next batch on."""
    spark = pending.sparkSession
    epoch = batch_id // fold_every
    if epoch and batch_id % fold_every == 0:
        fold_epoch(spark, store, epoch, fold_every)
    # stored once: the settlement reads the rows twice, and a stream's state must not be run twice
    new = materialize(pending.dropDuplicates(["transaction_id"]))
    balances = accounts.select("account_id", "balance").join(
        net_before(spark, store, batch_id, fold_every), "account_id", "left").select(
        "account_id", (F.col("balance") + F.coalesce("delta", F.lit(0))).cast("decimal(20,2)").alias("balance"))
    path = f"{store}/decisions/batch={batch_id}"
    ledger.settle_batch(new, balances).write.mode("overwrite").parquet(path)
    settled = spark.read.schema(DECISIONS).parquet(path)
    _summed(ledger.ledger_movements(settled)).write.mode("overwrite").parquet(
        f"{store}/net/epoch={epoch}/batch={batch_id}")


def stream_settle(events: DataFrame, accounts: DataFrame, store: str, checkpoint: str, available_now: bool = True,
                  fold_every: int = FOLD_EVERY):
    """PENDING transfer events → SUCCESS / FAILED with the batch settlement's
    rules, idempotent by transaction id without a time limit: debits, credits to
    the receiver, refund for an unknown receiver, FAILED for an unknown sender or
    a bad amount. The decisions are the rows of ``store``/decisions;
    ``ledger.status_events`` makes their status events, ``ledger.ledger_movements``
    their ledger. ``store`` and ``checkpoint`` belong together and are kept or
    dropped together."""
    def settle(batch: DataFrame, batch_id: int) -> None:
        settle_micro_batch(batch, accounts, store, batch_id, fold_every)

    new = pending_transfers(events).dropDuplicates(["transaction_id"])
    w = new.writeStream.option("checkpointLocation", checkpoint).foreachBatch(settle)
    return (w.trigger(availableNow=True) if available_now else w).start()
