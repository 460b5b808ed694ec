"""Sinks: audit CSV per day, report text (key<TAB>value) and its parser."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens.schemas import AUDIT_COLUMNS
from remitlens.streaming.events import audit_csv_lines

AUDIT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in AUDIT_COLUMNS]
                            + [T.StructField("audit_date", T.StringType())])


def audit_csv_sink(audit: DataFrame, path: str, mode: str = "append") -> None:
    """Audit rows → one CSV directory per day (header per file), appended."""
    (audit_csv_lines(audit).hint("rebalance", "audit_date")
     .write.mode(mode).partitionBy("audit_date").option("header", "true").csv(path))


def read_audit_csv(spark: SparkSession, path: str) -> DataFrame:
    fields = [T.StructField(c, T.StringType()) for c in AUDIT_COLUMNS]
    return (spark.read.schema(T.StructType(fields + [T.StructField("audit_date", T.StringType())]))
            .option("header", "true").option("nullValue", "\u0001").option("basePath", path).csv(path))


def write_report_text(report: DataFrame, key_cols: list[str], value_cols: list[str], path: str) -> None:
    """Report rows as ``k1|k2<TAB>v1,v2`` text lines (the MapReduce output form)."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols])
    value = F.concat_ws(",", *[F.col(c).cast("string") for c in value_cols])
    report.select(F.concat_ws("\t", key, value).alias("value")).write.mode("overwrite").text(path)


def result_text_parse(spark: SparkSession, path: str, key_names: list[str],
                      value_types: list[tuple[str, str]]) -> DataFrame:
    """Parse ``key<TAB>value`` report text back to typed rows; lines with too
    few parts or values that do not parse are skipped."""
    lines = spark.read.text(path)
    parts = F.split(F.col("value"), "\t")
    keys = F.split(parts.getItem(0), r"\|")
    vals = F.split(parts.getItem(1), ",")
    cols = [F.trim(keys.getItem(i)).alias(n) for i, n in enumerate(key_names)]
    cols += [F.trim(vals.getItem(i)).try_cast(t).alias(n) for i, (n, t) in enumerate(value_types)]
    out = lines.where(F.size(parts) >= 2).select(*cols)
    for n, _ in value_types:
        out = out.where(F.col(n).isNotNull())
    return out
