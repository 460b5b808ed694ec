"""Typed schemas of the transfer model (tables, fact rows, events, audit rows)."""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# Fact row: one per side of a transfer (OUT at the sender, IN at the receiver).
FACT_COLUMNS = [
    "transaction_id", "owner_user_id", "owner_account_id", "direction",
    "counterparty_account_id", "amount", "status", "created_at",
    "province", "district", "year", "quarter", "month",
]
PARTITION_COLUMNS = ["province", "district", "year", "quarter"]

# Text layout of the fact CSV: every field is read as a string and typed with
# try_cast afterwards, so a malformed value drops its row instead of the job.
# The four partition columns also appear inside each line; they get file-side
# names so Spark does not confuse them with the directory columns.
FACT_CSV_FILE_COLUMNS = [
    "transaction_id", "owner_user_id", "owner_account_id", "direction",
    "counterparty_account_id", "amount", "status", "created_at",
    "f_province", "f_district", "f_year", "f_quarter", "month",
]

# Monthly transactions CSV: id, from_account, to_account, amount, status, date.
MONTHLY_CSV_SCHEMA = T.StructType([
    T.StructField(c, T.StringType())
    for c in ["id", "from_account", "to_account", "amount", "status", "date"]
])

TRANSFER_EVENT_SCHEMA = T.StructType([
    T.StructField("eventId", T.StringType()),
    T.StructField("transactionId", T.StringType()),
    T.StructField("fromAccountId", T.StringType()),
    T.StructField("fromAccountNumber", T.StringType()),
    T.StructField("senderUserId", T.StringType()),
    T.StructField("fromProvince", T.StringType()),
    T.StructField("fromDistrict", T.StringType()),
    T.StructField("toAccountId", T.StringType()),
    T.StructField("toAccountNumber", T.StringType()),
    T.StructField("receiverUserId", T.StringType()),
    T.StructField("toProvince", T.StringType()),
    T.StructField("toDistrict", T.StringType()),
    T.StructField("amount", MONEY),
    T.StructField("currency", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])

AUDIT_COLUMNS = [
    "transaction_id", "from_account", "to_account", "amount", "status",
    "description", "fail_reason", "processed_at", "created_at",
]
