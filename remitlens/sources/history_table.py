"""Transfer history as a bucketed, sorted table.

``history_user``, ``page_history`` and their like ask for the newest rows of a
user. Bucketed by user and sorted newest first inside each bucket, one user's
page reads one bucket, and pages of all users need no exchange of the rows:
every bucket holds whole users. A user with very many rows is dealt over several
keys, so no bucket, and no task, holds all of them; such a user's page is the
first rows of the first rows of each key. A Parquet Bloom filter on the
transaction id lets a lookup by id skip files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from remitlens.session import materialize
from remitlens.sources.fact_table import fresh_name

BUCKETS, HOT_ROWS = 16, 1_000_000
_ORDER = ["_age", "_id"]


def _key(user: Column, part: Column) -> Column:
    return F.concat_ws("#", user.cast("string"), part.cast("string"))


def create(parts: DataFrame, name: str | None = None, buckets: int = BUCKETS, hot_rows: int = HOT_ROWS) -> str:
    """Write history rows (one per transfer and involved user) as a table; its
    number of buckets should let a bucket fit a task (about 1 GB of rows). Users
    of more than ``hot_rows`` rows are dealt over a key for each so many rows; the
    table ``<name>_hot`` lists them (at most rows / ``hot_rows``)."""
    spark = parts.sparkSession
    name = name or fresh_name(spark, "history")
    parts = materialize(parts)  # counted, then written
    hot = (parts.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
           .select("user_id", F.ceil(F.col("n") / F.lit(hot_rows)).cast("int").alias("keys")))
    hot.write.format("parquet").saveAsTable(f"{name}_hot")
    hot = spark.table(f"{name}_hot")
    part = F.coalesce(F.pmod(F.xxhash64("transaction_id"), F.col("keys")), F.lit(0))
    rows = parts.join(hot, "user_id", "left").withColumns({  # bucket files sort upwards only: age and id count down
        "_key": _key(F.col("user_id"), part), "_hot": F.col("keys").isNotNull(),
        "_age": -F.unix_micros(F.col("created_at").cast("timestamp")), "_id": -F.col("transaction_id")}).drop("keys")
    (rows.repartition(buckets, "_key").write.format("parquet").bucketBy(buckets, "_key").sortBy("_key", *_ORDER)
     .option("parquet.bloom.filter.enabled#transaction_id", "true").saveAsTable(name))
    return name


def _paged(rows: DataFrame, page: int, size: int) -> DataFrame:
    """``rows`` with ``_rn`` and ``total_elements`` → the page."""
    first = page * size
    return (rows.where((F.col("_rn") > first) & (F.col("_rn") <= first + size))
            .withColumn("total_pages", F.ceil(F.col("total_elements") / F.lit(size)).cast("bigint"))
            .withColumn("position", (F.col("_rn") - 1).cast("bigint")).drop("_rn", "_key", "_hot", *_ORDER))


def _of_whole_keys(rows: DataFrame, page: int, size: int) -> DataFrame:
    """Pages of users whose rows have one key: no exchange, rows and totals in one read."""
    of_key = Window.partitionBy("_key")
    return _paged(rows.withColumns({"_rn": F.row_number().over(of_key.orderBy(*_ORDER)),
                                    "total_elements": F.count(F.lit(1)).over(of_key)}), page, size)


def _of_parted_keys(rows: DataFrame, page: int, size: int) -> DataFrame:
    """Pages of users over several keys: only the first rows of each key move."""
    last = (page + 1) * size
    some = rows.withColumn("_rn", F.row_number().over(Window.partitionBy("_key").orderBy(*_ORDER))).where(F.col("_rn") <= last)
    totals = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("total_elements"))
    ranked = some.withColumn("_rn", F.row_number().over(Window.partitionBy("user_id").orderBy(*_ORDER)))
    return _paged(ranked.join(totals, "user_id"), page, size)


def pages(spark: SparkSession, name: str, page: int = 0, size: int = 20) -> DataFrame:
    """One page of every user, newest first, with total_elements and total_pages."""
    rows = spark.table(name)
    if spark.table(f"{name}_hot").isEmpty():
        return _of_whole_keys(rows, page, size)
    whole, parted = _of_whole_keys(rows.where("NOT _hot"), page, size), _of_parted_keys(rows.where("_hot"), page, size)
    return whole.unionByName(parted)


def page_of_user(spark: SparkSession, name: str, user_id: int, page: int = 0, size: int = 20) -> DataFrame:
    """One page of one user: the bucket of the user's key is read (of each key of a hot user)."""
    hot = spark.table(f"{name}_hot").where(F.col("user_id") == user_id).first()
    keys = [f"{user_id}#{i}" for i in range(hot["keys"] if hot else 1)]
    rows = spark.table(name).where(F.col("_key").isin(keys))
    return _of_parted_keys(rows, page, size) if hot else _of_whole_keys(rows, page, size)


def transfer(spark: SparkSession, name: str, transaction_id: int) -> DataFrame:
    """The rows of one transfer; the Bloom filters tell which files may hold it."""
    return spark.table(name).where(F.col("transaction_id") == transaction_id).drop("_key", "_hot", *_ORDER)
