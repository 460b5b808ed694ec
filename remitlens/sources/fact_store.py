"""The partitioned fact store: province=/district=/year=/quarter= directories.

Writers spread rows with the ``rebalance`` hint keyed by the partition columns:
AQE then sizes the write tasks from shuffle statistics — it splits a hot
partition (one province holding a third of the rows) across several tasks and
merges tiny ones — instead of one task per directory. Readers give an explicit
schema so partition values are never re-typed by inference (``01`` stays a
string, ``''`` never appears because blanks are written as ``Unknown``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens.functions import scalars as S
from remitlens.schemas import FACT_CSV_FILE_COLUMNS, MONTHLY_CSV_SCHEMA, PARTITION_COLUMNS
from remitlens.session import remove_path

PARTITION_SCHEMA = T.StructType([
    T.StructField("province", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("quarter", T.StringType()),
])


def partition_safe(fact: DataFrame) -> DataFrame:
    def fix(c):
        return F.when(F.col(c).isNull() | (F.trim(F.col(c)) == ""), F.lit("Unknown")).otherwise(F.col(c))
    return fact.withColumn("province", fix("province")).withColumn("district", fix("district"))


def write_fact_partitioned(fact: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
                           overwrite: str | None = None) -> None:
    """Append fact rows under their partition directory (new files, never
    overwriting existing ones); ``fmt='csv'`` writes the 13-column text layout."""
    df = partition_safe(fact)
    if fmt == "csv":
        df = df.select(fact_line(df).alias("value"), *PARTITION_COLUMNS)
    writer = (df.hint("rebalance", *PARTITION_COLUMNS)
              .write.mode(mode).partitionBy(*PARTITION_COLUMNS))
    if overwrite:
        writer = writer.option("partitionOverwriteMode", overwrite)
    if fmt == "csv":
        writer.text(path)
    else:
        writer.parquet(path)


def fact_line(fact: DataFrame) -> Column:
    """A fact row as a line of the 13-column text layout, which knows no quoting:
    NULL is an empty field, and a comma or line end inside a field becomes a
    space (directory names keep province and district as they are)."""
    fields = [F.col(c) for c in FACT_CSV_FILE_COLUMNS[:5]]
    whole = F.date_trunc("second", "created_at") == F.col("created_at")
    second = "yyyy-MM-dd'T'HH:mm:ss"  # a fraction is written only where there is one
    fields += [F.col("amount"), F.col("status"),
               F.when(whole, F.date_format("created_at", second)).otherwise(F.date_format("created_at", second + ".SSSSSS"))]
    fields += [F.col(c) for c in PARTITION_COLUMNS] + [F.col("month")]
    text = [F.translate(F.coalesce(f.cast("string"), F.lit("")), ",\n\r", "   ") for f in fields]
    return F.concat_ws(",", *text)


def replace_partitions(fact: DataFrame, path: str, fmt: str = "parquet", all_partitions: bool = False) -> None:
    """Rewrite the partitions present in ``fact`` (dynamic overwrite), or clear
    and rewrite the whole store with ``all_partitions=True`` (static). The mode
    is an option of this write; the session's setting stays."""
    write_fact_partitioned(fact, path, fmt=fmt, mode="overwrite",
                           overwrite="static" if all_partitions else "dynamic")


def delete_partition(spark: SparkSession, path: str, province: str, district: str, year: int, quarter: str) -> bool:
    """Clear one slice of the file store: its folder goes and no other file is
    touched. Whether there was one. (``fact_table`` does the same through a catalog.)"""
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    values = zip(PARTITION_COLUMNS, (province, district, year, quarter), strict=True)
    return remove_path(spark, "/".join([path.rstrip("/"), *[f"{c}={escaped(str(v))}" for c, v in values]]))


def read_fact_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read the Parquet store; data columns keep their file types, partition
    columns get fixed types (no inference of '01' → 1)."""
    files = spark.read.option("basePath", path).parquet(path).schema
    data = [f for f in files.fields if f.name not in PARTITION_COLUMNS]
    schema = T.StructType(data + list(PARTITION_SCHEMA.fields))
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def scan_fact_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read the 13-column fact CSV, schema-on-read.

    Lines are read as text and split on commas (keeping empty trailing
    fields), like the text layout is written: lines are trimmed, blank lines
    and header lines skipped, rows with fewer than 13 fields and rows whose
    amount does not parse dropped. created_at is parsed leniently (ISO local
    date-time, optional seconds/fraction) and the raw text kept for a strict
    parse. The four partition columns come from the directory names.
    """
    schema = T.StructType([T.StructField("value", T.StringType())] + list(PARTITION_SCHEMA.fields))
    raw = spark.read.schema(schema).option("basePath", path).text(path)
    line = S.java_trim(F.col("value"))
    parts = F.split(line, ",", -1)
    rows = raw.where((line != "") & ~line.startswith("transaction_id") & (F.size(parts) >= len(FACT_CSV_FILE_COLUMNS)))

    def field(i):
        return S.java_trim(parts.getItem(i))

    idx = {c: i for i, c in enumerate(FACT_CSV_FILE_COLUMNS)}
    typed = rows.select(
        field(idx["transaction_id"]).alias("transaction_id"),
        field(idx["owner_user_id"]).alias("owner_user_id"),
        field(idx["owner_account_id"]).alias("owner_account_id"),
        F.upper(field(idx["direction"])).alias("direction"),
        field(idx["counterparty_account_id"]).alias("counterparty_account_id"),
        S.amount_parse(parts.getItem(idx["amount"])).alias("amount"),
        field(idx["status"]).alias("status"),
        S.ts_parse(parts.getItem(idx["created_at"])).alias("created_at"),
        field(idx["created_at"]).alias("created_at_raw"),
        F.col("province"), F.col("district"), F.col("year"), F.col("quarter"),
        field(idx["month"]).alias("month"))
    return typed.where(F.col("amount").isNotNull())


def scan_monthly_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the monthly transactions text files (month=.../): id,
    from_account, to_account, amount, status, date.

    Lines are trimmed; blank lines, header lines (starting with ``id``), lines
    with fewer than four fields and lines whose amount does not parse drop."""
    raw = spark.read.schema("value string, month string").option("basePath", path).text(path)
    line = S.java_trim(F.col("value"))
    parts = F.split(line, ",", -1)
    rows = raw.where((line != "") & ~F.lower(line).startswith("id") & (F.size(parts) >= 4))
    fields = [S.java_trim(F.get(parts, F.lit(i))).alias(c) for i, c in enumerate(MONTHLY_CSV_SCHEMA.fieldNames())
              if c != "amount"]
    return rows.select("month", *fields, S.amount_parse(F.get(parts, F.lit(3))).alias("amount")) \
        .where(F.col("amount").isNotNull())


def scan_partition(fact: DataFrame, province: str, district: str, year: int, quarter: str) -> DataFrame:
    """One (province, district, year, quarter) slice — pruned to one directory."""
    return fact.where((F.col("province") == province) & (F.col("district") == district)
                      & (F.col("year") == year) & (F.col("quarter") == quarter))


def scan_province_quarter(fact: DataFrame, province: str, year: int, quarter: str) -> DataFrame:
    return fact.where((F.col("province") == province) & (F.col("year") == year) & (F.col("quarter") == quarter))


def scan_quarter_glob(fact: DataFrame, year: int, quarter: str) -> DataFrame:
    """All provinces/districts of a year+quarter; no matching files → empty frame."""
    return fact.where((F.col("year") == year) & (F.col("quarter") == quarter))


def list_partitions(fact: DataFrame) -> DataFrame:
    """Existing (province, district, year, quarter) values. No data column is
    read, but the scan opens every file for its row count."""
    return fact.select(*PARTITION_COLUMNS).distinct()


def partition_exists(fact: DataFrame, province: str, district: str, year: int, quarter: str) -> DataFrame:
    """One row: whether the slice has any row (stops at the first match)."""
    hit = scan_partition(fact, province, district, year, quarter).select(F.lit(1).alias("x")).limit(1)
    return hit.agg((F.count(F.lit(1)) > 0).alias("exists"))
