"""The fact store as a partitioned catalog table.

The catalog knows every slice (province, district, year, quarter), so listing
slices opens no data file, and a slice is cleared or rewritten by itself:
``ALTER TABLE … DROP PARTITION`` and ``INSERT OVERWRITE … PARTITION`` touch its
folder only. Tables live in the database ``remitlens``, whose folder lies in the
shared checkpoint folder; with a persistent catalog (a metastore) they outlive the
session, otherwise ``attach`` registers the files of an earlier one again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.schemas import PARTITION_COLUMNS
from remitlens.session import checkpoint_root, remove_path
from remitlens.sources.fact_store import PARTITION_SCHEMA, partition_safe, read_fact_parquet

DATABASE = "remitlens"


def database(spark: SparkSession) -> str:
    """The database of the stored tables, made on first use in the shared folder."""
    if not spark.catalog.databaseExists(DATABASE):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE} LOCATION '{checkpoint_root(spark)}/remitlens/tables'")
    return DATABASE


def fresh_name(spark: SparkSession, kind: str) -> str:
    return f"{database(spark)}.{kind}_{uuid.uuid4().hex[:12]}"


def create(fact: DataFrame, name: str) -> str:
    """Write ``fact`` as the partitioned table ``name``; its name is returned.
    Rows are dealt by the partition columns with ``rebalance``, so a hot slice
    is written by several tasks and a small one by one."""
    (partition_safe(fact).hint("rebalance", *PARTITION_COLUMNS)
     .write.mode("errorifexists").format("parquet").partitionBy(*PARTITION_COLUMNS).saveAsTable(name))
    return name


def attach(spark: SparkSession, path: str, name: str) -> str:
    """Register the files of a partitioned store at ``path`` as the table ``name``
    (the catalog then lists its slices; dropping a slice leaves the files)."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read_fact_parquet(spark, path).schema)
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def append(fact: DataFrame, name: str) -> None:
    """Add rows; new slices enter the catalog."""
    table = fact.sparkSession.table(name)
    (partition_safe(fact).select(*table.columns).hint("rebalance", *PARTITION_COLUMNS)
     .write.mode("append").insertInto(name))


def _spec(province: str, district: str, year: int, quarter: str) -> str:
    def text(v):
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"province = {text(province)}, district = {text(district)}, year = {int(year)}, quarter = {text(quarter)}"


def _part(column: Column, i: int) -> Column:
    """The i-th value of a partition path; the catalog escapes special letters as %XX."""
    value = F.substring_index(F.get(F.split(column, "/"), F.lit(i)), "=", -1)
    return F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))


def list_partitions(spark: SparkSession, name: str) -> DataFrame:
    """The (province, district, year, quarter) of all slices, from the catalog alone."""
    paths = spark.sql(f"SHOW PARTITIONS {name}")
    return paths.select(*[_part(F.col("partition"), i).cast(f.dataType).alias(f.name)
                          for i, f in enumerate(PARTITION_SCHEMA.fields)])


def partition_exists(spark: SparkSession, name: str, province: str, district: str, year: int, quarter: str) -> DataFrame:
    """One row: whether the catalog has the slice."""
    found = spark.sql(f"SHOW PARTITIONS {name} PARTITION ({_spec(province, district, year, quarter)})")
    return found.agg((F.count(F.lit(1)) > 0).alias("exists"))


def delete_partition(spark: SparkSession, name: str, province: str, district: str, year: int, quarter: str) -> None:
    """Clear one slice: its folder goes and no other file is touched. A slice
    that is not there is no error."""
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({_spec(province, district, year, quarter)})")


def replace_partition(fact: DataFrame, name: str, province: str, district: str, year: int, quarter: str) -> None:
    """Rewrite one slice with the rows of ``fact`` that belong to it; with none,
    the slice is cleared."""
    spark = fact.sparkSession
    rows = partition_safe(fact).where(
        (F.col("province") == province) & (F.col("district") == district)
        & (F.col("year") == year) & (F.col("quarter") == quarter))
    data = [c for c in spark.table(name).columns if c not in PARTITION_COLUMNS]
    view = f"slice_{uuid.uuid4().hex[:12]}"
    rows.select(*data).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({_spec(province, district, year, quarter)}) SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def replace_partitions(fact: DataFrame, name: str, gone: DataFrame | None = None) -> None:
    """Rewrite the slices that ``fact`` has rows of; slices of ``gone`` (their four
    columns, as many rows as slices) that ``fact`` has no rows of are cleared.
    Other slices stay as they are."""
    spark = fact.sparkSession
    fact = partition_safe(fact)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # INSERT has no option of its own for it
    try:
        (fact.select(*spark.table(name).columns).hint("rebalance", *PARTITION_COLUMNS)
         .write.mode("overwrite").insertInto(name, overwrite=True))
    finally:
        spark.conf.set(mode, before)
    if gone is not None:
        empty = gone.select(*PARTITION_COLUMNS).distinct().join(fact, PARTITION_COLUMNS, "left_anti")
        for r in empty.toLocalIterator():  # one row a slice, as the catalog has them
            delete_partition(spark, name, r["province"], r["district"], r["year"], r["quarter"])


# ---------------------------------------------------------------- compaction

def location(spark: SparkSession, name: str) -> str:
    return spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]


def slice_files(spark: SparkSession, name: str) -> DataFrame:
    """(slice, folder, files, bytes) of all slices' present folders, from listings
    alone: the files' content column is never asked for, so no file is opened."""
    paths = [r["path"] for r in folders(spark, name).select("path").collect()]  # one row a slice
    if not paths:
        return spark.createDataFrame([], "province string, district string, year int, quarter string, path string, "
                                         "files bigint, bytes bigint")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(paths)
    sizes = listed.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("path")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    return folders(spark, name).join(sizes, "path")


def folders(spark: SparkSession, name: str) -> DataFrame:
    """(slice, path): the folder that the catalog reads each slice from."""
    session = spark._jsparkSession.sessionState()
    parts = session.catalog().listPartitions(session.sqlParser().parseTableIdentifier(name),
                                             spark._jvm.scala.Option.empty())
    rows = []
    for i in range(parts.size()):
        spec = parts.apply(i).spec()
        path = spark._jvm.org.apache.hadoop.fs.Path(parts.apply(i).location()).toString()  # without the URI's escapes
        rows.append((spec.apply("province"), spec.apply("district"), int(spec.apply("year")), spec.apply("quarter"), path))
    return spark.createDataFrame(rows, "province string, district string, year int, quarter string, path string")


def compact(spark: SparkSession, name: str, target_bytes: int = 256 << 20, most_files: int = 8) -> list[str]:
    """Rewrite the slices that have more than ``most_files`` files, and more than
    their bytes need, into files of about ``target_bytes``.

    One job writes all of them to a fresh folder; then the catalog is pointed to
    the new folders one by one. A reader sees a slice's old files or its new ones,
    both with the same rows; the old ones stay until ``remove_folders`` takes the
    returned list, once no reader uses them. A job that fails half-way leaves the
    table as it was. Rows that are added to a slice while it is rewritten would be
    lost, so appends and compaction of a table take turns.
    """
    need = F.greatest(F.ceil(F.col("bytes") / F.lit(target_bytes)), F.lit(1))
    small = [r.asDict() for r in slice_files(spark, name).withColumn("need", need)
             .where((F.col("files") > most_files) & (F.col("files") > F.col("need"))).collect()]  # one row a slice
    if not small:
        return []
    keys = spark.createDataFrame([(r["province"], r["district"], r["year"], r["quarter"], int(r["need"])) for r in small],
                                 "province string, district string, year int, quarter string, _need int")
    fresh = f"{location(spark, name)}/compacted-{uuid.uuid4().hex[:12]}"
    rows = spark.table(name).join(keys, PARTITION_COLUMNS)
    # as many tasks, and so files, a slice as its bytes need
    part = F.floor(F.rand(7) * F.col("_need")).cast("int")
    (rows.withColumn("_part", part).repartition(max(1, sum(int(r["need"]) for r in small)), *PARTITION_COLUMNS, "_part")
     .drop("_need", "_part").write.partitionBy(*PARTITION_COLUMNS).parquet(fresh))
    new = {tuple(r[c] for c in PARTITION_COLUMNS): r["path"] for r in _written(spark, fresh).collect()}
    for r in small:
        at = new[tuple(r[c] for c in PARTITION_COLUMNS)]
        spec = _spec(r["province"], r["district"], r["year"], r["quarter"])
        spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION '{_quoted(at)}'")
    spark.catalog.refreshTable(name)
    return [r["path"] for r in small]


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def _written(spark: SparkSession, path: str) -> DataFrame:
    """(slice, path) of the slice folders under ``path``."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    folder = F.regexp_extract("path", "/(province=.*)/[^/]*$", 1)
    return listed.select(F.regexp_replace("path", "/[^/]*$", "").alias("path"), *[
        _part(folder, i).cast(f.dataType).alias(f.name) for i, f in enumerate(PARTITION_SCHEMA.fields)]).distinct()


def remove_folders(spark: SparkSession, folders: list[str]) -> None:
    """Remove the old folders that ``compact`` returned."""
    for folder in folders:
        remove_path(spark, folder)
