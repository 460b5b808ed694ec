"""Structured Streaming jobs: ingest, dedup, velocity alerts (settlement: ``settle``).

The source is built in one place (``transfer_source``): Kafka in production
(``startingOffsets=earliest``) or a JSON file folder for tests. How many
records a micro-batch takes and how often one starts are parameters without a
limit by default.
Everything after it is source-agnostic and identical to the batch code.
Every sink has a checkpoint location in the shared checkpoint folder, so a
restarted query resumes exactly where it stopped (file sinks are exactly-once).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens.functions import scalars as S
from remitlens.operators import facts
from remitlens.schemas import PARTITION_COLUMNS, TRANSFER_EVENT_SCHEMA
from remitlens.streaming.events import event_to_fact

# Fixed values of the consumer configuration and the velocity rules.
TRANSFER_TOPIC = "transfer-topic"
LARGE_AMOUNT = 500_000_000
# Event files keep microseconds (Spark's JSON default stops at milliseconds).
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_event_files(events: DataFrame, path: str, mode: str = "errorifexists") -> None:
    events.write.mode(mode).option("timestampFormat", JSON_TS_FORMAT).json(path)


def transfer_events(geo: DataFrame) -> DataFrame:
    """TransferEvent rows for settled-or-pending transfers (geo rows)."""
    return geo.select(
        F.concat(F.lit("ev-"), F.col("transaction_id").cast("string")).alias("eventId"),
        F.col("transaction_id").cast("string").alias("transactionId"),
        F.col("from_id").cast("string").alias("fromAccountId"),
        F.col("from_account").alias("fromAccountNumber"),
        F.col("from_user_id").cast("string").alias("senderUserId"),
        F.col("from_province").alias("fromProvince"), F.col("from_district").alias("fromDistrict"),
        F.col("to_id").cast("string").alias("toAccountId"),
        F.col("to_account").alias("toAccountNumber"),
        F.col("to_user_id").cast("string").alias("receiverUserId"),
        F.col("to_province").alias("toProvince"), F.col("to_district").alias("toDistrict"),
        F.col("amount"), F.lit("VND").alias("currency"), F.lit(None).cast("string").alias("description"),
        F.col("status"),
        F.to_utc_timestamp(F.col("created_at").cast("timestamp"), "UTC").alias("timestamp"))


def parsed_events(values: DataFrame) -> DataFrame:
    """TransferEvent rows of a ``value`` column of JSON text, and ``malformed``:
    the text itself where it can't be read as an event (no JSON, a field of
    another type, no transaction id), null for a good event."""
    schema = T.StructType(TRANSFER_EVENT_SCHEMA.fields + [T.StructField("_corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "timestampFormat": JSON_TS_FORMAT}
    # Exploded, so that a filter on the event stays behind it: pushed below, each of its
    # terms would parse the text again.
    event = values.select("value", F.explode(F.array(F.from_json(S.json_unwrap(F.col("value")), schema, options))).alias("e"))
    bad = F.col("e").isNull() | F.col("e._corrupt").isNotNull() | F.col("e.transactionId").isNull()
    return event.select("e.*", F.when(bad, F.coalesce("value", F.lit(""))).alias("malformed")).drop("_corrupt")


def transfer_source(spark: SparkSession, kind: str = "kafka", path: str | None = None,
                    bootstrap: str | None = None, topic: str = TRANSFER_TOPIC,
                    max_files_per_trigger: int | None = None,
                    max_offsets_per_trigger: int | None = None, with_malformed: bool = False) -> DataFrame:
    """Streaming DataFrame of TransferEvent rows; the two ``max_...`` bounds of a
    micro-batch are unset by default. Malformed events are left out, or kept with
    their text in ``malformed`` (see ``stream_quarantine``)."""
    if kind == "kafka":
        raw = (spark.readStream.format("kafka")
               .option("kafka.bootstrap.servers", bootstrap)
               .option("subscribe", topic)
               .option("startingOffsets", "earliest"))
        if max_offsets_per_trigger:
            raw = raw.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        raw = raw.load().select(F.col("value").cast("string").alias("value"))
    else:
        reader = spark.readStream
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        raw = reader.text(path).where(F.trim("value") != "")
    events = parsed_events(raw)
    return events if with_malformed else events.where("malformed IS NULL").drop("malformed")


def stream_quarantine(events: DataFrame, out_path: str, checkpoint: str, available_now: bool = True):
    """Events of ``transfer_source(..., with_malformed=True)`` → one sink with the
    good events under ``kind=good`` and the malformed ones, with their text, under
    ``kind=malformed``. One pass over the source; each batch's files of both kinds
    are committed together."""
    kind = F.when(F.col("malformed").isNull(), F.lit("good")).otherwise(F.lit("malformed"))
    w = (events.withColumn("kind", kind).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).partitionBy("kind"))
    return (w.trigger(availableNow=True) if available_now else w).start(out_path)


def stream_dedup(events: DataFrame, delay: str | None = None) -> DataFrame:
    """Idempotency by transaction id. Without ``delay`` an id is skipped for ever:
    the ids are keyed state (RocksDB keeps recent ones in memory and older ones in
    sorted files with Bloom filters, so a micro-batch looks up its own ids only).
    With ``delay`` an id is forgotten once the watermark has passed it by so much,
    which bounds the state, and a later repeat passes."""
    if delay is None:
        return events.dropDuplicates(["transactionId"])
    return events.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["transactionId"])


def stream_results_once(results: DataFrame) -> DataFrame:
    """Result events, each (transaction, status) once for ever, so that a repeated
    event gives no second notification however late it comes."""
    return results.dropDuplicates(["transactionId", "status"])


def stream_fact_ingest(events: DataFrame, out_path: str, checkpoint: str, available_now: bool = False,
                       trigger: str | None = None, delay: str | None = None):
    """Transfer events → dedup → OUT/IN fact rows → append to the partitioned store.

    A repeated event is dropped before it is exploded (``stream_dedup``). Rows
    are dealt by the partition columns and a part of the transaction id, so a
    hot folder's rows of one micro-batch spread over several tasks (and files)
    while other folders get few.
    """
    fact = facts.fact_geo_explode(event_to_fact(stream_dedup(events, delay)))
    fact = fact.repartition(*PARTITION_COLUMNS, F.pmod(F.xxhash64("transaction_id"), F.lit(4)))
    w = (fact.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).partitionBy(*PARTITION_COLUMNS))
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start(out_path)


def velocity_alerts(fact: DataFrame, delay: str = "10 minutes", min_per_minute: int = 2,
                    large_threshold=LARGE_AMOUNT, large_min_per_hour: int = 3,
                    min_counterparties: int = 5) -> DataFrame:
    """Live velocity checks over OUT rows, in one stream: (kind, window_start,
    district, owner_account_id, n) of

    - RAPID_FIRE: at least ``min_per_minute`` transfers of an account in a minute,
    - LARGE_AMOUNT: at least ``large_min_per_hour`` transfers of
      ``large_threshold`` or more in an hour,
    - FAN_OUT: at least ``min_counterparties`` different counterparties in an hour.

    Each row becomes one row a rule, tagged with its window. Two stateful steps
    follow: a window keeps each transfer (FAN_OUT: each counterparty) once, as
    rows of keyed state spread over all partitions and not as one set, and the
    window is counted. An alert comes when its window is closed: the watermark
    runs on the windows' ends, so it lies an hour (the longest window) and
    ``delay`` behind the newest transfer. A repeated transfer counts once.
    """
    ts = F.col("created_at").cast("timestamp")
    minute, hour = F.date_trunc("minute", ts), F.date_trunc("hour", ts)

    def rule(kind, start, width, once):
        return F.struct(F.lit(kind).alias("kind"), (start + F.expr(f"INTERVAL {width}")).alias("window_end"),
                        once.cast("string").alias("once"))

    transfer = F.col("transaction_id")
    rules = F.array(  # a rule that doesn't apply is dropped behind the explode, where nothing is computed twice
        rule("RAPID_FIRE", minute, "1 MINUTE", transfer),
        F.when(F.col("amount") >= F.lit(large_threshold), rule("LARGE_AMOUNT", hour, "1 HOUR", transfer)),
        rule("FAN_OUT", hour, "1 HOUR", F.col("counterparty_account_id")))
    key = ["kind", "window_end", "district", "owner_account_id"]
    width = F.when(F.col("kind") == "RAPID_FIRE", F.expr("INTERVAL 1 MINUTE")).otherwise(F.expr("INTERVAL 1 HOUR"))
    least = (F.when(F.col("kind") == "RAPID_FIRE", min_per_minute).when(F.col("kind") == "LARGE_AMOUNT", large_min_per_hour)
             .otherwise(min_counterparties))
    return (fact.where(F.col("direction") == "OUT")
            .select("district", "owner_account_id", F.explode(rules).alias("r"))
            .where("r IS NOT NULL").select("district", "owner_account_id", "r.*")
            .where((F.col("kind") != "FAN_OUT") | F.col("once").isNotNull())
            .withWatermark("window_end", f"{delay} 1 hour")
            .dropDuplicates([*key, "once"])
            .groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= least)
            .select("kind", (F.col("window_end") - width).alias("window_start"), "district", "owner_account_id", "n"))


def stream_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a streaming frame to completion over the available input
    (availableNow) into Parquet; ``mode='update'`` writes each micro-batch's
    changed rows with its batch id (read back with ``latest_rows``)."""
    if mode == "append":
        q = (df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start(path))
    else:
        def write_batch(batch: DataFrame, batch_id: int) -> None:
            batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(path)
        q = (df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
             .foreachBatch(write_batch).trigger(availableNow=True).start())
    q.awaitTermination()


def latest_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Final value per key of an update-mode table: the row of the last batch."""
    df = spark.read.parquet(path)
    w = Window.partitionBy(*keys).orderBy(F.desc("_batch"))
    return df.withColumn("_turn", F.row_number().over(w)).where(F.col("_turn") == 1).drop("_turn", "_batch")
