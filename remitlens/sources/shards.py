"""Regional shards (CENTRAL / NORTH / MID / SOUTH) and their union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shard_scan_jdbc(spark: SparkSession, urls: dict[str, str], table: str, props: dict | None = None,
                    partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                    num_partitions: int = 8) -> DataFrame:
    """The same table from several databases, tagged with its shard name.

    With ``partition_column`` and bounds each shard is read by
    ``num_partitions`` parallel range queries instead of one connection.
    """
    frames = []
    for shard, url in urls.items():
        r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
        for k, v in (props or {}).items():
            r = r.option(k, v)
        if partition_column is not None:
            r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
                 .option("upperBound", upper).option("numPartitions", num_partitions))
        frames.append(r.load().withColumn("shard", F.lit(shard)))
    return shard_union(frames)


def shard_scan_files(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """File-backed shards (same role as the JDBC reader, used where no database runs)."""
    return shard_union([spark.read.format(fmt).load(p).withColumn("shard", F.lit(s)) for s, p in paths.items()])


def shard_union(frames: list[DataFrame]) -> DataFrame:
    """Union by column name (shards may list columns in different orders)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
