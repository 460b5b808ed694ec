"""The transfer model derived from the driver tables.

users     customer ⋈ nation ⋈ region (one account per user)
accounts  the same customers as accounts (negative balance → SUSPENDED)
tx        history transfers, one per order (dates 1995..2001)
etx       intraday transfers, one per event (January 2024, microsecond times)

Every frame is a lazy plan over the parquet tables; nothing is collected.
Receiver ids are derived with scalar subqueries (``DataFrame.scalar()``), which
Spark evaluates once inside the same plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.schemas import MONEY

TABLE_NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# The provinces of nations 0 to 23 (nation 24 has none): ten of
# the north, eight of the middle, six of the south.
PROVINCES = [
    "Hà Nội", "Hải Phòng", "Bắc Ninh", "Hà Nam", "Hải Dương", "Hưng Yên", "Nam Định", "Ninh Bình", "Thái Bình",
    "Vĩnh Phúc", "Thanh Hóa", "Nghệ An", "Hà Tĩnh", "Quảng Bình", "Quảng Trị", "Thừa Thiên Huế", "Đà Nẵng",
    "Quảng Nam", "Hồ Chí Minh", "Cần Thơ", "An Giang", "Bến Tre", "Cà Mau", "Long An",
]
# Fixed values of the account-number rule: numbers are 100000000000 + key (12 digits).
ACCOUNT_NUMBER_BASE = 100000000000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, full_name, account_number, balance, province, district, region."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    return c.join(geo, c.c_nationkey == geo.n_nationkey).select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("full_name"),
        (F.lit(ACCOUNT_NUMBER_BASE) + F.col("c_custkey")).cast("string").alias("account_number"),
        F.col("c_acctbal").alias("balance"),
        F.get(F.array(*[F.lit(p) for p in PROVINCES]), F.col("c_nationkey").cast("int")).alias("province"),
        F.col("c_mktsegment").alias("district"),
        F.col("r_name").alias("region"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """account_id, user_id, account_number, balance (decimal), status."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("account_id"),
        F.col("c_custkey").alias("user_id"),
        (F.lit(ACCOUNT_NUMBER_BASE) + F.col("c_custkey")).cast("string").alias("account_number"),
        F.col("c_acctbal").cast(MONEY).alias("balance"),
        F.when(F.col("c_acctbal") < 0, F.lit("SUSPENDED")).otherwise(F.lit("ACTIVE")).alias("status"),
    )


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History transfers: transaction_id, from_id, to_id, amount, status, created_at."""
    o = table(spark, sf_dir, "orders")
    n_customers = table(spark, sf_dir, "customer").select(F.count(F.lit(1))).scalar()
    status = (F.when(F.col("o_orderstatus") == "F", "SUCCESS")
              .when(F.col("o_orderstatus") == "O", "PENDING")
              .when(F.col("o_orderpriority") == "1-URGENT", "REVERSED")
              .when(F.col("o_orderpriority") == "2-HIGH", "COMPLETED")
              .otherwise("FAILED"))
    return o.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("from_id"),
        ((F.col("o_custkey") + F.col("o_orderkey") * 7) % n_customers).alias("to_id"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        status.alias("status"),
        F.col("o_orderdate").alias("created_at"),
    )


def etx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intraday transfers: transaction_id, from_id, to_id, amount, status, created_at."""
    e = table(spark, sf_dir, "events")
    n_users = e.select(F.max("user_id") + 1).scalar()
    other = F.when(F.col("event_id") % 3 == 0, "REVERSED").otherwise("FAILED")
    status = (F.when(F.col("event_type").isin("purchase", "click"), "SUCCESS")
              .when(F.col("event_type") == "view", "COMPLETED")
              .when(F.col("event_type") == "signup", "PENDING")
              .otherwise(other))
    return e.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("from_id"),
        ((F.col("user_id") + 1 + F.col("event_id") % 7) % n_users).alias("to_id"),
        F.col("value").cast(MONEY).alias("amount"),
        status.alias("status"),
        F.col("ts").alias("created_at"),
    )
