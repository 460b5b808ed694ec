"""Reports from mergeable summaries of the fact table's slices.

A summary row holds what the reports need of one slice's rows with equal
direction, status, month, day and hour: their number and amount; a second kind
holds one HyperLogLog sketch of (account, hour, counterparty) for each slice and
direction. All of it merges by sums and sketch unions, so a refresh reads only
the slices whose files changed, and the reports read no fact row at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.functions import scalars as S
from remitlens.schemas import PARTITION_COLUMNS
from remitlens.sources import fact_table

SKETCH_LOG2 = 14  # 2^14 registers: a relative error of about 0.8 %, 16 KB a slice and direction


def _summary(fact: DataFrame) -> DataFrame:
    """Summary rows (``sketch`` null) and sketch rows (``n`` null) of all slices of ``fact``."""
    rows = fact.where(F.col("amount").isNotNull()).select(
        *PARTITION_COLUMNS, F.upper(S.java_trim(F.col("direction"))).alias("dir"), "status", "month", "amount", "created_at",
        F.struct(S.java_trim(F.col("owner_account_id").cast("string")).alias("a"), F.date_trunc("hour", "created_at").alias("h"),
                 S.java_trim(F.col("counterparty_account_id").cast("string")).alias("c")).alias("combo"))
    sums = rows.groupBy(*PARTITION_COLUMNS, "dir", "status", "month", F.dayofmonth("created_at").alias("day"),
                        F.hour("created_at").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(28,2)").alias("amount"))
    sketches = rows.where(F.col("created_at").isNotNull()).groupBy(*PARTITION_COLUMNS, "dir").agg(
        F.hll_sketch_agg(F.to_json("combo"), SKETCH_LOG2).alias("sketch"))
    return sums.withColumn("sketch", F.lit(None).cast("binary")).unionByName(sketches, allowMissingColumns=True)


def _files(spark: SparkSession, name: str) -> DataFrame:
    """(slice, files): a digest of the names, lengths and times of each slice's
    files, from listings alone (the files' content column is never asked for)."""
    folders = [r["path"] for r in fact_table.folders(spark, name).select("path").collect()]  # one row a slice
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folders) if folders else \
        spark.createDataFrame([], "path string, modificationTime timestamp, length bigint")
    one = F.xxhash64("path", "length", "modificationTime")
    digests = listed.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("path")).agg(
        F.concat_ws(":", F.count(F.lit(1)), F.bit_xor(one)).alias("files"))
    return fact_table.folders(spark, name).join(digests, "path").drop("path")


def create(spark: SparkSession, fact_name: str, name: str) -> str:
    """An empty summary table ``name`` of the fact table ``fact_name``; ``refresh`` fills it."""
    empty = _summary(spark.table(fact_name)).where("false").withColumn("files", F.lit("")).select(
        *[c for c in _summary(spark.table(fact_name)).columns if c not in PARTITION_COLUMNS], "files", *PARTITION_COLUMNS)
    empty.write.format("parquet").partitionBy(*PARTITION_COLUMNS).saveAsTable(name)
    return name


def changed_slices(spark: SparkSession, fact_name: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(slices to summarise, with the digest of their files; slices that are gone)."""
    now = _files(spark, fact_name)
    known = spark.table(name).groupBy(*PARTITION_COLUMNS).agg(F.max("files").alias("_known"))
    both = now.join(known, PARTITION_COLUMNS, "full")
    return (both.where("files IS NOT NULL AND (_known IS NULL OR _known <> files)").drop("_known"),
            both.where("files IS NULL").select(*PARTITION_COLUMNS))


def refresh(spark: SparkSession, fact_name: str, name: str) -> list[tuple]:
    """Summarise the slices whose files changed since the last refresh, and drop
    those that are gone. Returns the slices read (one row a changed slice, as the
    catalog has them): their predicate prunes the fact table to their folders."""
    todo, gone = changed_slices(spark, fact_name, name)
    slices = [tuple(r) for r in todo.select(*PARTITION_COLUMNS, "files").collect()]
    for r in gone.collect():
        fact_table.delete_partition(spark, name, *r)
    if slices:
        digests = spark.createDataFrame(slices, "province string, district string, year int, quarter string, files string")
        rows = _summary(spark.table(fact_name).where(_one_of(slices))).join(digests, PARTITION_COLUMNS)
        fact_table.replace_partitions(rows, name)
        spark.catalog.refreshTable(name)
    return [s[:4] for s in slices]


def _one_of(slices: list[tuple]):
    """The predicate that a row lies in one of the slices: by province first, so it stays short and prunes folders."""
    by_province: dict = {}
    for province, *rest in slices:
        by_province.setdefault(province, []).append(rest)
    out = F.lit(False)
    for province, rest in by_province.items():
        own = F.lit(False)
        for district, year, quarter, *_ in rest:
            own = own | ((F.col("district") == district) & (F.col("year") == year) & (F.col("quarter") == quarter))
        out = out | ((F.col("province") == province) & own)
    return out


# ---------------------------------------------------------------- reports

def province_density(summary: DataFrame) -> DataFrame:
    return (summary.where("sketch IS NULL").groupBy(S.blank_to(F.col("province"), S.UNKNOWN).alias("province"))
            .agg(F.sum("n").alias("n")))


def peak_totals(summary: DataFrame, month: str) -> DataFrame:
    """Count and amount of successful OUT rows by hour and by day of ``month``."""
    y, m = (int(x) for x in month.split("-"))
    rows = summary.where((F.col("year") == y) & (F.col("quarter") == f"Q{(m - 1) // 3 + 1}") & F.col("sketch").isNull()
                         & (F.col("dir") == "OUT") & S.is_success(F.col("status")) & (S.java_trim(F.col("month")) == month))
    sums = [F.sum("n").alias("n"), F.sum("amount").alias("amount")]
    hours = rows.groupBy("hour").agg(*sums).select(F.lit("HOUR_TOTAL").alias("level"), F.col("hour").alias("key"), "n", "amount")
    days = rows.groupBy("day").agg(*sums).select(F.lit("DAY_TOTAL").alias("level"), F.col("day").alias("key"), "n", "amount")
    return hours.unionByName(days)


def quarter_totals(summary: DataFrame, year: int) -> DataFrame:
    """Per quarter of ``year``: amount, rows and SUCCESS rows (both sides, rows with a status)."""
    rows = summary.where((F.col("year") == year) & F.col("sketch").isNull() & (F.col("status") != ""))
    ok = F.upper(F.col("status")) == "SUCCESS"
    return rows.groupBy("quarter").agg(
        F.sum("amount").alias("total_amount"), F.sum("n").alias("tx_count"),
        F.coalesce(F.sum(F.when(ok, F.col("n"))), F.lit(0)).alias("success_count"))


def fan_out(summary: DataFrame, year: int, quarter: str) -> DataFrame:
    """About how many different (account, hour, counterparty) each district has among OUT rows."""
    rows = summary.where((F.col("year") == year) & (F.col("quarter") == quarter) & F.col("sketch").isNotNull() & (F.col("dir") == "OUT"))
    return rows.groupBy(S.blank_to(F.col("district"), S.UNKNOWN).alias("district")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("fan_out"))
