"""Event projections shared by batch and streaming jobs.

transfer event → fact input (event_to_fact), result event → audit row
(stream_audit), result event → notification rows (stream_notifications).
All are stateless column expressions, so the same function serves a static
DataFrame and a streaming one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.functions import scalars as S

RESULT_STATUSES = ["COMPLETED", "FAILED", "REVERSED"]


def result_events(geo: DataFrame) -> DataFrame:
    """Transaction-result events derived from settled transfers (geo rows):
    the COMPLETED / FAILED / REVERSED outcomes with parties and reason."""
    rows = geo.where(F.col("status").isin(*RESULT_STATUSES))
    return rows.select(
        F.col("transaction_id").cast("string").alias("transactionId"),
        F.col("from_account").alias("fromAccountId"),
        F.col("to_account").alias("toAccountId"),
        F.col("from_user_id").cast("string").alias("fromUserId"),
        F.col("to_user_id").cast("string").alias("toUserId"),
        F.col("amount"),
        F.concat(F.lit("transfer,"), F.col("transaction_id").cast("string")).alias("description"),
        F.col("status"),
        F.when(F.col("status") == "FAILED", F.lit("insufficient,balance")).alias("failReason"),
        F.col("created_at").alias("processedAt"),
        F.col("created_at").alias("createdAt"))


def event_to_fact(events: DataFrame, zone: str = "UTC") -> DataFrame:
    """TransferEvent rows → fact-input (geo) rows; the event instant becomes a
    local time in ``zone``, and a missing instant becomes now()."""
    ts = F.coalesce(F.col("timestamp"), F.current_timestamp())
    return events.select(
        F.col("transactionId").alias("transaction_id"),
        F.col("senderUserId").alias("from_user_id"), F.col("fromAccountNumber").alias("from_account"),
        F.col("fromProvince").alias("from_province"), F.col("fromDistrict").alias("from_district"),
        F.col("receiverUserId").alias("to_user_id"), F.col("toAccountNumber").alias("to_account"),
        F.col("toProvince").alias("to_province"), F.col("toDistrict").alias("to_district"),
        F.col("amount"), F.col("status"),
        F.to_timestamp_ntz(F.date_format(F.from_utc_timestamp(ts, zone), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .alias("created_at"))


def audit_rows(results: DataFrame, now: Column | None = None) -> DataFrame:
    """Result event → audit row: missing id → 'unknown', amount null → 0.0,
    processedAt null → now. (The from/to 'account number' columns of the
    reference hold account ids; they are named *_account here.)"""
    now = now if now is not None else F.localtimestamp()
    return results.select(
        F.coalesce(F.col("transactionId"), F.lit("unknown")).alias("transaction_id"),
        F.col("fromAccountId").alias("from_account"),
        F.col("toAccountId").alias("to_account"),
        F.coalesce(F.col("amount").cast("double"), F.lit(0.0)).alias("amount"),
        F.col("status"), F.col("description"), F.col("failReason").alias("fail_reason"),
        F.coalesce(F.col("processedAt"), now.cast("timestamp_ntz")).alias("processed_at"),
        F.col("createdAt").alias("created_at"))


def audit_csv_lines(audit: DataFrame) -> DataFrame:
    """Audit rows in the CSV text form: nulls → '' / 0.0 / 'UNKNOWN', commas in
    description and reason → space, amount '%.2f', audit_date partition."""
    def blank(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))
    return audit.select(
        blank("transaction_id").alias("transaction_id"), blank("from_account").alias("from_account"),
        blank("to_account").alias("to_account"),
        F.format_string("%.2f", F.coalesce(F.col("amount").cast("double"), F.lit(0.0))).alias("amount"),
        F.coalesce(F.col("status"), F.lit("UNKNOWN")).alias("status"),
        F.replace(blank("description"), F.lit(","), F.lit(" ")).alias("description"),
        F.replace(blank("fail_reason"), F.lit(","), F.lit(" ")).alias("fail_reason"),
        F.coalesce(F.date_format("processed_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("")).alias("processed_at"),
        F.coalesce(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("")).alias("created_at"),
        F.date_format(F.coalesce(F.col("processed_at"), F.col("created_at")), "yyyy-MM-dd").alias("audit_date"))


def notification_rows(results: DataFrame) -> DataFrame:
    """COMPLETED → sender + receiver rows; FAILED → one ALERT to the sender with
    the reason; REVERSED → one row to the sender; other statuses → none.
    One row per (transaction, user, type): both consumers of the reference emit
    the same messages, they are produced once here."""
    amount = S.money_format(F.col("amount"))
    desc = F.coalesce(F.col("description"), F.lit(""))
    reason = F.coalesce(F.col("failReason"), F.lit("Không rõ"))

    def row(user, message, kind):
        return F.struct(user.alias("user_id"), message.alias("message"), F.lit(kind).alias("type"))

    sender = F.col("fromUserId").cast("string")
    receiver = F.col("toUserId").cast("string")
    rows = (F.when(F.col("status") == "COMPLETED", F.array(
                row(sender, F.concat(F.lit("Chuyển tiền "), amount, F.lit(" thành công. "), desc), "TRANSACTION"),
                row(receiver, F.concat(F.lit("Bạn vừa nhận được "), amount, F.lit(". "), desc), "TRANSACTION")))
            .when(F.col("status") == "FAILED", F.array(
                row(sender, F.concat(F.lit("Chuyển tiền "), amount, F.lit(" thất bại. Lý do: "), reason), "ALERT")))
            .when(F.col("status") == "REVERSED", F.array(
                row(sender, F.concat(F.lit("Giao dịch "), amount, F.lit(" đã bị hoàn tiền.")), "TRANSACTION"))))
    return (results.select(F.col("transactionId").alias("transaction_id"), F.col("processedAt").alias("created_at"),
                           F.explode(rows).alias("n"))
            .select("transaction_id", "n.user_id", "n.type", "n.message", "created_at",
                    F.lit(False).alias("is_read")))
