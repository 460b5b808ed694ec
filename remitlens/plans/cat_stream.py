"""Registered streaming queries. Transfer events derived from the tables are
written as JSON files to a fresh folder; the streaming job runs to completion
over them (availableNow) into a Parquet sink with its own checkpoint, and the
sink is read back as the query result."""

from __future__ import annotations

from pyspark.sql import functions as F

from remitlens.operators import facts
from remitlens.plans.cat_ledger import _SETTLE, settle_input
from remitlens.plans.model_frames import Frames
from remitlens.plans.registry import register
from remitlens.session import scratch_path
from remitlens.streaming import pipeline, settle
from remitlens.streaming.events import event_to_fact

_EVENTS_SQL = """
, ev AS (
  SELECT 'ev-' || CAST(transaction_id AS VARCHAR) AS eventId, CAST(transaction_id AS VARCHAR) AS transactionId,
         CAST(from_id AS VARCHAR) AS fromAccountId, from_account AS fromAccountNumber,
         CAST(from_user_id AS VARCHAR) AS senderUserId, from_province AS fromProvince, from_district AS fromDistrict,
         CAST(to_id AS VARCHAR) AS toAccountId, to_account AS toAccountNumber,
         CAST(to_user_id AS VARCHAR) AS receiverUserId, to_province AS toProvince, to_district AS toDistrict,
         CAST(amount AS DOUBLE) AS amount, 'VND' AS currency, status, created_at AS "timestamp"
  FROM geo)
"""
_EVENT_COLS = ["eventId", "transactionId", "fromAccountId", "fromAccountNumber", "senderUserId", "fromProvince",
               "fromDistrict", "toAccountId", "toAccountNumber", "receiverUserId", "toProvince", "toDistrict"]


def _event_files(spark, sf_dir, copies: int = 1) -> str:
    ev = pipeline.transfer_events(Frames(spark, sf_dir).geo)
    path = scratch_path(spark, "transfer-events")
    src = ev
    for _ in range(copies - 1):
        src = src.unionByName(ev)
    pipeline.write_event_files(src, path)
    return path


def _run(spark, df, mode="append"):
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    pipeline.stream_to_table(df, out, ckpt, mode=mode)
    return out


def _event_out(df):
    return df.select(*_EVENT_COLS, F.col("amount").cast("double").alias("amount"), "currency", "status",
                     F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


@register("stream_transfer_source", _EVENTS_SQL + "SELECT * EXCLUDE (\"timestamp\"), \"timestamp\" FROM ev")
def q_stream_transfer_source(spark, sf_dir):
    src = pipeline.transfer_source(spark, kind="files", path=_event_files(spark, sf_dir))
    out = _run(spark, src.drop("description"))
    return _event_out(spark.read.parquet(out))


@register("stream_dedup", _EVENTS_SQL + "SELECT * EXCLUDE (\"timestamp\"), \"timestamp\" FROM ev")
def q_stream_dedup(spark, sf_dir):
    """Every event delivered twice; the dedup keeps one per transaction id."""
    src = pipeline.transfer_source(spark, kind="files", path=_event_files(spark, sf_dir, copies=2))
    out = _run(spark, pipeline.stream_dedup(src).drop("description"))
    return _event_out(spark.read.parquet(out))


@register("event_to_fact", """
SELECT transaction_id, from_user_id, from_account, from_province, from_district, to_user_id, to_account,
       to_province, to_district, CAST(amount AS DOUBLE) AS amount, status, created_at FROM geo""")
def q_event_to_fact(spark, sf_dir):
    ev = pipeline.transfer_events(Frames(spark, sf_dir).geo)
    g = event_to_fact(ev)
    return g.select(F.col("transaction_id").cast("bigint").alias("transaction_id"),
                    F.col("from_user_id").cast("bigint").alias("from_user_id"), "from_account", "from_province",
                    "from_district", F.col("to_user_id").cast("bigint").alias("to_user_id"), "to_account",
                    "to_province", "to_district", F.col("amount").cast("double").alias("amount"), "status",
                    "created_at")


@register("stream_fact_ingest", """
SELECT transaction_id, owner_user_id, owner_account_id, direction, counterparty_account_id,
       CAST(amount AS DOUBLE) AS amount, status, created_at, province, district, CAST(year AS BIGINT) AS year,
       quarter, month
FROM fact""")
def q_stream_fact_ingest(spark, sf_dir):
    src = pipeline.transfer_source(spark, kind="files", path=_event_files(spark, sf_dir))
    out, ckpt = scratch_path(spark, "fact-stream"), scratch_path(spark, "fact-stream-ckpt")
    pipeline.stream_fact_ingest(src, out, ckpt, available_now=True).awaitTermination()
    f = spark.read.parquet(out)
    return f.select(F.col("transaction_id").cast("bigint").alias("transaction_id"),
                    F.col("owner_user_id").cast("bigint").alias("owner_user_id"), "owner_account_id", "direction",
                    "counterparty_account_id", F.col("amount").cast("double").alias("amount"), "status",
                    "created_at", "province", "district", F.col("year").cast("bigint").alias("year"), "quarter",
                    "month")


@register("stream_velocity", """
SELECT 'RAPID_FIRE' AS kind, date_trunc('minute', created_at) AS window_start, district, owner_account_id,
       CAST(count(*) AS BIGINT) AS n
FROM fact WHERE direction = 'OUT'
GROUP BY district, owner_account_id, date_trunc('minute', created_at) HAVING count(*) >= 2
UNION ALL
SELECT 'LARGE_AMOUNT', date_trunc('hour', created_at), district, owner_account_id, CAST(count(*) AS BIGINT)
FROM fact WHERE direction = 'OUT' AND amount >= 50
GROUP BY district, owner_account_id, date_trunc('hour', created_at) HAVING count(*) >= 2
UNION ALL
SELECT 'FAN_OUT', date_trunc('hour', created_at), district, owner_account_id,
       CAST(count(DISTINCT counterparty_account_id) AS BIGINT)
FROM fact WHERE direction = 'OUT'
GROUP BY district, owner_account_id, date_trunc('hour', created_at) HAVING count(DISTINCT counterparty_account_id) >= 2""")
def q_stream_velocity(spark, sf_dir):
    """All three rules in one stream over events that come twice; thresholds sized
    for this data. A last event of no account, days later, closes all windows."""
    path = _event_files(spark, sf_dir, copies=2)
    last = Frames(spark, sf_dir).etx.agg(F.max("created_at").alias("t")).select(
        F.lit("heartbeat").alias("transactionId"),
        F.to_utc_timestamp((F.col("t") + F.expr("INTERVAL 2 DAYS")).cast("timestamp"), "UTC").alias("timestamp"))
    pipeline.write_event_files(last, path, mode="append")
    fact = facts.fact_geo_explode(event_to_fact(pipeline.transfer_source(spark, kind="files", path=path)))
    r = spark.read.parquet(_run(spark, pipeline.velocity_alerts(
        fact, large_threshold=50, large_min_per_hour=2, min_counterparties=2)))
    return r.select("kind", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "district",
                    "owner_account_id", "n")


@register("stream_quarantine", """
, line AS (
  SELECT CAST(transaction_id AS VARCHAR) AS id, transaction_id % 20 AS c FROM etx)
SELECT CASE WHEN c < 4 THEN 'malformed' ELSE 'good' END AS kind,
       CASE c WHEN 0 THEN '{"transactionId":"' || id || '","amount":' WHEN 1 THEN '{"transactionId":"' || id || '","amount":"n/a"}'
              WHEN 2 THEN '{"eventId":"' || id || '","amount":1}' WHEN 3 THEN 'no event ' || id ELSE id END AS id_or_text
FROM line""")
def q_stream_quarantine(spark, sf_dir):
    """Events as lines of text; one in five is cut off, of another type, without
    an id, or no JSON at all."""
    id_ = F.col("transaction_id").cast("string")
    c, start = F.col("transaction_id") % 20, F.concat(F.lit('{"transactionId":"'), id_)
    line = (F.when(c == 0, F.concat(start, F.lit('","amount":'))).when(c == 1, F.concat(start, F.lit('","amount":"n/a"}')))
            .when(c == 2, F.concat(F.lit('{"eventId":"'), id_, F.lit('","amount":1}')))
            .when(c == 3, F.concat(F.lit("no event "), id_))
            .otherwise(F.concat(start, F.lit('","amount":'), F.col("amount").cast("string"), F.lit("}"))))
    path, out = scratch_path(spark, "event-lines"), scratch_path(spark, "quarantine")
    Frames(spark, sf_dir).etx.select(line.alias("value")).write.text(path)
    events = pipeline.transfer_source(spark, kind="files", path=path, with_malformed=True)
    pipeline.stream_quarantine(events, out, scratch_path(spark, "quarantine-ckpt")).awaitTermination()
    return spark.read.parquet(out).select("kind", F.coalesce("malformed", "transactionId").alias("id_or_text"))


@register("stream_settle", recursive=True, oracle=_SETTLE + """
SELECT transaction_id, from_id, to_id, CAST(amount AS DOUBLE) AS amount, created_at, status, reason FROM settled""")
def q_stream_settle(spark, sf_dir):
    """Every event delivered twice; the decisions equal the batch settlement."""
    fr = Frames(spark, sf_dir)
    events = settle_input(fr.etx).select(
        F.col("transaction_id").cast("string").alias("transactionId"), F.col("from_id").cast("string").alias("fromAccountId"),
        F.col("to_id").cast("string").alias("toAccountId"), "amount", "status",
        F.to_utc_timestamp(F.col("created_at").cast("timestamp"), "UTC").alias("timestamp"))
    path, store = scratch_path(spark, "pending-events"), scratch_path(spark, "settle-store")
    pipeline.write_event_files(events.unionByName(events), path)
    src = pipeline.transfer_source(spark, kind="files", path=path)
    settle.stream_settle(src, fr.accounts, store, scratch_path(spark, "settle-ckpt")).awaitTermination()
    r = spark.read.schema(settle.DECISIONS + ", batch bigint").parquet(f"{store}/decisions")
    return r.select("transaction_id", "from_id", "to_id", F.col("amount").cast("double").alias("amount"),
                    "created_at", "status", "reason")
