"""Registered source/sink queries: each writes derived data to a fresh folder
under the shared checkpoint directory and reads it back through the operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from remitlens.functions import scalars as S
from remitlens.operators import density, facts, slice_summary
from remitlens.plans.model_frames import Frames
from remitlens.plans.registry import register
from remitlens.session import scratch_path
from remitlens.sources import fact_store, fact_table, shards, sinks, stores
from remitlens.streaming import events, pipeline

SLICE = dict(province="CanTho", district="Building", year=2024, quarter="Q1")
REGION_ORDER = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

_FACT_OUT = """SELECT CAST(transaction_id AS BIGINT) AS transaction_id, CAST(owner_user_id AS BIGINT) AS owner_user_id,
       owner_account_id, direction, counterparty_account_id, CAST(amount AS DOUBLE) AS amount, status, created_at,
       province, district, CAST(year AS BIGINT) AS year, quarter, month"""


def _fact_out(df):
    return df.select(F.col("transaction_id").cast("bigint").alias("transaction_id"),
                     F.col("owner_user_id").cast("bigint").alias("owner_user_id"),
                     F.col("owner_account_id").cast("string").alias("owner_account_id"), "direction",
                     F.col("counterparty_account_id").cast("string").alias("counterparty_account_id"),
                     F.col("amount").cast("double").alias("amount"), "status", "created_at", "province",
                     "district", F.col("year").cast("bigint").alias("year"), "quarter", "month")


FACT_TABLES = ("events", "customer", "nation", "region")


def _once(spark, sf_dir, name, build, tables=FACT_TABLES):
    """What ``build(path)`` writes, once per version of the tables it comes from."""
    def write():
        path = scratch_path(spark, name)
        build(path)
        return path
    return stores.once(spark, name, [f"{sf_dir}/{t}.parquet" for t in tables], write)


def _store(spark, sf_dir, fmt="parquet"):
    return _once(spark, sf_dir, f"fact-{fmt}",
                 lambda path: fact_store.write_fact_partitioned(Frames(spark, sf_dir).fact, path, fmt=fmt))


def _parquet_store(spark, sf_dir):
    return fact_store.read_fact_parquet(spark, _store(spark, sf_dir))


@register("scan_fact_csv", _FACT_OUT + " FROM fact")
def q_scan_fact_csv(spark, sf_dir):
    return _fact_out(fact_store.scan_fact_csv(spark, _store(spark, sf_dir, "csv")))


@register("write_fact_partitioned", _FACT_OUT + " FROM fact")
def q_write_fact_partitioned(spark, sf_dir):
    path = scratch_path(spark, "fact-written")
    fact_store.write_fact_partitioned(Frames(spark, sf_dir).fact, path)
    return _fact_out(fact_store.read_fact_parquet(spark, path))


@register("scan_partition", _FACT_OUT + """ FROM fact
WHERE province = 'CanTho' AND district = 'Building' AND year = 2024 AND quarter = 'Q1'""")
def q_scan_partition(spark, sf_dir):
    return _fact_out(fact_store.scan_partition(_parquet_store(spark, sf_dir), **SLICE))


@register("scan_province_quarter", _FACT_OUT + """ FROM fact
WHERE province = 'CanTho' AND year = 2024 AND quarter = 'Q1'""")
def q_scan_province_quarter(spark, sf_dir):
    return _fact_out(fact_store.scan_province_quarter(_parquet_store(spark, sf_dir), "CanTho", 2024, "Q1"))


@register("scan_quarter_glob", _FACT_OUT + " FROM fact WHERE year = 2024 AND quarter = 'Q1'")
def q_scan_quarter_glob(spark, sf_dir):
    return _fact_out(fact_store.scan_quarter_glob(_parquet_store(spark, sf_dir), 2024, "Q1"))


def _table(spark, sf_dir):
    """The fact as a catalog table of its own, to be changed."""
    return fact_table.create(Frames(spark, sf_dir).fact, fact_table.fresh_name(spark, "fact"))


def _shared_table(spark, sf_dir):
    return stores.once(spark, "fact-table", [f"{sf_dir}/{t}.parquet" for t in FACT_TABLES], lambda: _table(spark, sf_dir))


@register("list_partitions", """
SELECT DISTINCT province, district, CAST(year AS BIGINT) AS year, quarter FROM fact""")
def q_list_partitions(spark, sf_dir):
    p = fact_table.list_partitions(spark, _shared_table(spark, sf_dir))
    return p.select("province", "district", F.col("year").cast("bigint").alias("year"), "quarter")


@register("partition_exists", """
SELECT count(*) > 0 AS "exists" FROM fact
WHERE province = 'CanTho' AND district = 'Building' AND year = 2024 AND quarter = 'Q1'""")
def q_partition_exists(spark, sf_dir):
    return fact_table.partition_exists(spark, _shared_table(spark, sf_dir), **SLICE)


@register("replace_partitions", _FACT_OUT + " FROM fact WHERE province <> 'CanTho' OR (status = 'SUCCESS' AND district <> 'Building')")
def q_replace_partitions(spark, sf_dir):
    """One province rewritten with its settled rows of all districts but one,
    whose slices are cleared; other provinces stay."""
    name = _table(spark, sf_dir)
    mine = Frames(spark, sf_dir).fact.where(F.col("province") == "CanTho")
    fact_table.replace_partitions(mine.where("status = 'SUCCESS' AND district <> 'Building'"), name, gone=mine)
    return _fact_out(spark.table(name))


@register("delete_partition", _FACT_OUT + """ FROM fact
WHERE NOT (province = 'CanTho' AND district = 'Building' AND year = 2024 AND quarter = 'Q1')""")
def q_delete_partition(spark, sf_dir):
    name = _table(spark, sf_dir)
    fact_table.delete_partition(spark, name, **SLICE)
    return _fact_out(spark.table(name))


@register("compact_partitions", _FACT_OUT + " FROM fact WHERE year = 2024 AND quarter = 'Q1'")
def q_compact_partitions(spark, sf_dir):
    """A quarter that came in three parts, compacted; the rows read from the new files."""
    rows = fact_store.scan_quarter_glob(Frames(spark, sf_dir).fact, 2024, "Q1")
    name = None
    for i in range(3):
        part = rows.where(F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == i)
        if name is None:
            name = fact_table.create(part, fact_table.fresh_name(spark, "fact"))
        else:
            fact_table.append(part, name)
    fact_table.remove_folders(spark, fact_table.compact(spark, name, most_files=2))
    return _fact_out(spark.table(name))


# ---------------------------------------------------------------- summaries of slices

def _summary(spark, sf_dir):
    """Summaries of the fact table without one province, then refreshed after
    its slices came in: the second refresh reads these slices only."""
    def build():
        fact = Frames(spark, sf_dir).fact
        late = F.col("province") == "CanTho"
        name = fact_table.create(fact.where(~late), fact_table.fresh_name(spark, "fact"))
        summary = slice_summary.create(spark, name, fact_table.fresh_name(spark, "summary"))
        slice_summary.refresh(spark, name, summary)
        fact_table.append(fact.where(late), name)
        spark.catalog.refreshTable(name)
        slice_summary.refresh(spark, name, summary)
        return summary
    return spark.table(stores.once(spark, "summary", [f"{sf_dir}/{t}.parquet" for t in FACT_TABLES], build))


@register("summary_density", "SELECT province, CAST(count(*) AS BIGINT) AS n FROM fact WHERE amount IS NOT NULL GROUP BY province")
def q_summary_density(spark, sf_dir):
    return slice_summary.province_density(_summary(spark, sf_dir))


@register("summary_peaks", """
, ok AS (
  SELECT * FROM fact WHERE direction = 'OUT' AND status IN ('SUCCESS', 'COMPLETED') AND month = '2024-01' AND amount IS NOT NULL)
SELECT 'HOUR_TOTAL' AS level, CAST(hour(created_at) AS BIGINT) AS key, CAST(count(*) AS BIGINT) AS n, CAST(sum(amount) AS DOUBLE) AS amount
FROM ok GROUP BY hour(created_at)
UNION ALL
SELECT 'DAY_TOTAL', CAST(day(created_at) AS BIGINT), CAST(count(*) AS BIGINT), CAST(sum(amount) AS DOUBLE) FROM ok GROUP BY day(created_at)""")
def q_summary_peaks(spark, sf_dir):
    return slice_summary.peak_totals(_summary(spark, sf_dir), "2024-01").select(
        "level", F.col("key").cast("bigint").alias("key"), "n", F.col("amount").cast("double").alias("amount"))


@register("summary_quarters", """
SELECT quarter, CAST(sum(amount) AS DOUBLE) AS total_amount, CAST(count(*) AS BIGINT) AS tx_count,
       CAST(count(*) FILTER (upper(status) = 'SUCCESS') AS BIGINT) AS success_count
FROM fact WHERE year = 2024 AND amount IS NOT NULL AND status <> '' GROUP BY quarter""")
def q_summary_quarters(spark, sf_dir):
    return slice_summary.quarter_totals(_summary(spark, sf_dir), 2024).select(
        "quarter", F.col("total_amount").cast("double").alias("total_amount"), "tx_count", "success_count")


@register("result_text_parse", """
SELECT province, CAST(count(*) AS BIGINT) AS n FROM fact WHERE year = 2024 AND quarter = 'Q1' GROUP BY province""")
def q_result_text_parse(spark, sf_dir):
    path = scratch_path(spark, "density-report")
    report = density.province_density(fact_store.scan_quarter_glob(Frames(spark, sf_dir).fact, 2024, "Q1"))
    sinks.write_report_text(report, ["province"], ["n"], path)
    return sinks.result_text_parse(spark, path, ["province"], [("n", "bigint")])


# ---------------------------------------------------------------- shards

_SHARDS = """
, tagged AS (
  SELECT t.*, u.region AS from_region, v.region AS to_region
  FROM tx t JOIN users u ON u.user_id = t.from_id JOIN users v ON v.user_id = t.to_id),
shards AS (
  SELECT transaction_id, from_id, to_id, amount, status, created_at, from_region AS shard FROM tagged
  UNION ALL
  SELECT transaction_id, from_id, to_id, amount, 'SUCCESS', created_at, to_region FROM tagged
  WHERE from_region <> to_region)
"""
_SHARD_COLS = "transaction_id, from_id, to_id, CAST(amount AS DOUBLE) AS amount, status, created_at, shard"


def _shard_out(df):
    return df.select("transaction_id", "from_id", "to_id", F.col("amount").cast("double").alias("amount"),
                     "status", "created_at", "shard")


def _tagged_shards(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    return facts.shard_tag(fr.tx, fr.users)


@register("shard_union", _SHARDS + f"SELECT {_SHARD_COLS} FROM shards")
def q_shard_union(spark, sf_dir):
    """Shards written as one folder each by a single job, read back and unioned."""
    path = scratch_path(spark, "shards")
    tagged = _tagged_shards(spark, sf_dir).withColumn("folder", F.replace(F.col("shard"), F.lit(" "), F.lit("_")))
    tagged.drop("shard").write.partitionBy("folder").parquet(path)
    paths = {region: f"{path}/folder={region.replace(' ', '_')}" for region in REGION_ORDER}
    return _shard_out(shards.shard_scan_files(spark, paths))


@register("cross_region_copy", _SHARDS + f"""
SELECT {_SHARD_COLS} FROM shards WHERE status = 'SUCCESS' AND transaction_id % 3 <> 0 AND shard <> (
  SELECT region FROM users WHERE user_id = shards.from_id)""")
def q_cross_region_copy(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    region = fr.users.select("user_id", "region")
    t = (fr.tx.join(region.withColumnRenamed("user_id", "from_id").withColumnRenamed("region", "from_region"),
                    "from_id")
         .join(region.withColumnRenamed("user_id", "to_id").withColumnRenamed("region", "to_region"), "to_id"))
    # the receivers' shards hold every third transfer already; the copies are appended to their folders
    held = t.where(F.col("transaction_id") % 3 == 0).select("transaction_id", F.col("to_region").alias("shard"))
    path = scratch_path(spark, "shard-copies")
    facts.cross_region_copy(t, fr.tx.columns, held).write.mode("append").partitionBy("shard").parquet(path)
    return _shard_out(spark.read.parquet(path))


@register("export_union_dedup", _SHARDS + f"""
SELECT {_SHARD_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY
      list_position(['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'], shard) DESC) AS rn
  FROM shards) WHERE rn = 1""")
def q_export_union_dedup(spark, sf_dir):
    return _shard_out(facts.export_union_dedup(_tagged_shards(spark, sf_dir), REGION_ORDER))


_PLACES = """
, place AS (
  SELECT user_id, CASE WHEN province IS NULL THEN 'CENTRAL'
    WHEN province IN ('Hà Nội', 'Hải Phòng', 'Bắc Ninh', 'Hà Nam', 'Hải Dương', 'Hưng Yên', 'Nam Định', 'Ninh Bình',
                      'Thái Bình', 'Vĩnh Phúc') THEN 'NORTH'
    WHEN province IN ('Thanh Hóa', 'Nghệ An', 'Hà Tĩnh', 'Quảng Bình', 'Quảng Trị', 'Thừa Thiên Huế', 'Đà Nẵng',
                      'Quảng Nam') THEN 'MID' ELSE 'SOUTH' END AS region FROM users),
stations AS (
  SELECT t.transaction_id, from_id, to_id, amount, status, created_at, p.region AS shard
  FROM tx t JOIN place p ON p.user_id = from_id JOIN place q ON q.user_id = to_id
  UNION ALL
  SELECT t.transaction_id, from_id, to_id, amount, 'SUCCESS', created_at, q.region
  FROM tx t JOIN place p ON p.user_id = from_id JOIN place q ON q.user_id = to_id WHERE p.region <> q.region)
"""


@register("distinct_by_key", _PLACES + """
SELECT transaction_id, from_id, to_id, CAST(amount AS DOUBLE) AS amount, status, created_at, shard FROM stations
WHERE shard <> 'CENTRAL'
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY list_position(['NORTH', 'MID', 'SOUTH'], shard) DESC) = 1""")
def q_distinct_by_key(spark, sf_dir):
    """The three stations read one after the other: of an id's rows the last station's stays."""
    fr = Frames(spark, sf_dir)
    placed = fr.users.withColumn("region", S.region_of_province(F.col("province")))
    stations = ["NORTH", "MID", "SOUTH"]
    rows = facts.shard_tag(fr.tx, placed).where(F.col("shard").isin(stations))
    return _shard_out(facts.export_union_dedup(rows, stations))


@register("region_of_province", """
SELECT user_id, province, CASE WHEN province IS NULL THEN 'CENTRAL'
  WHEN province IN ('Hà Nội', 'Hải Phòng', 'Bắc Ninh', 'Hà Nam', 'Hải Dương', 'Hưng Yên', 'Nam Định', 'Ninh Bình',
                    'Thái Bình', 'Vĩnh Phúc') THEN 'NORTH'
  WHEN province IN ('Thanh Hóa', 'Nghệ An', 'Hà Tĩnh', 'Quảng Bình', 'Quảng Trị', 'Thừa Thiên Huế', 'Đà Nẵng',
                    'Quảng Nam') THEN 'MID' ELSE 'SOUTH' END AS shard FROM users""")
def q_region_of_province(spark, sf_dir):
    u = Frames(spark, sf_dir).users
    return u.select("user_id", "province", S.region_of_province(F.col("province")).alias("shard"))


# ---------------------------------------------------------------- audit / notifications

_RESULTS = """
, results AS (
  SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, from_account, to_account, amount, status,
         'transfer,' || CAST(transaction_id AS VARCHAR) AS description,
         CASE WHEN status = 'FAILED' THEN 'insufficient,balance' END AS fail_reason,
         created_at AS processed_at, created_at, from_user_id, to_user_id
  FROM geo WHERE status IN ('COMPLETED', 'FAILED', 'REVERSED'))
"""


def _results(spark, sf_dir):
    return events.result_events(Frames(spark, sf_dir).geo)


def _streamed(spark, sf_dir, rows, name, copies=1):
    """Result events as files (each ``copies`` times), read as a stream into a checkpointed Parquet sink."""
    source, sink = scratch_path(spark, f"{name}-events"), scratch_path(spark, f"{name}-sink")
    results = _results(spark, sf_dir)
    for _ in range(copies):
        results.write.mode("append").parquet(source)
    stream = rows(spark.readStream.schema(results.schema).parquet(source))
    pipeline.stream_to_table(stream, sink, scratch_path(spark, f"{name}-ckpt"))
    return spark.read.schema(stream.schema).parquet(sink)


@register("stream_audit", _RESULTS + """
SELECT transaction_id, from_account, to_account, CAST(amount AS DOUBLE) AS amount, status, description, fail_reason,
       processed_at, created_at FROM results""")
def q_stream_audit(spark, sf_dir):
    return _streamed(spark, sf_dir, events.audit_rows, "audit")


@register("audit_csv_sink", _RESULTS + """
SELECT transaction_id, from_account, to_account, printf('%.2f', CAST(amount AS DOUBLE)) AS amount, status,
       replace(description, ',', ' ') AS description, coalesce(replace(fail_reason, ',', ' '), '') AS fail_reason,
       strftime(processed_at, '%Y-%m-%dT%H:%M:%S.%f') AS processed_at,
       strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') AS created_at, strftime(processed_at, '%Y-%m-%d') AS audit_date
FROM results""")
def q_audit_csv_sink(spark, sf_dir):
    path = scratch_path(spark, "audit")
    sinks.audit_csv_sink(events.audit_rows(_results(spark, sf_dir)), path)
    return sinks.read_audit_csv(spark, path)


@register("audit_query", _RESULTS + """
SELECT transaction_id, from_account, to_account, CAST(amount AS DOUBLE) AS amount, status, processed_at
FROM results WHERE status = 'FAILED'""")
def q_audit_query(spark, sf_dir):
    from remitlens.operators.lookups import audit_query
    a = events.audit_rows(_results(spark, sf_dir))
    return audit_query(a, status="FAILED").select("transaction_id", "from_account", "to_account", "amount",
                                                  "status", "processed_at")


_NOTIF = _RESULTS + """
, notif AS (
  SELECT transaction_id, CAST(from_user_id AS VARCHAR) AS user_id, 'TRANSACTION' AS type,
         'Chuyển tiền ' || format('{:,}', CAST(round(amount, 0) AS BIGINT)) || ' VND thành công. ' || description AS message,
         processed_at AS created_at FROM results WHERE status = 'COMPLETED'
  UNION ALL
  SELECT transaction_id, CAST(to_user_id AS VARCHAR), 'TRANSACTION',
         'Bạn vừa nhận được ' || format('{:,}', CAST(round(amount, 0) AS BIGINT)) || ' VND. ' || description,
         processed_at FROM results WHERE status = 'COMPLETED'
  UNION ALL
  SELECT transaction_id, CAST(from_user_id AS VARCHAR), 'ALERT',
         'Chuyển tiền ' || format('{:,}', CAST(round(amount, 0) AS BIGINT)) || ' VND thất bại. Lý do: '
           || coalesce(fail_reason, 'Không rõ'),
         processed_at FROM results WHERE status = 'FAILED'
  UNION ALL
  SELECT transaction_id, CAST(from_user_id AS VARCHAR), 'TRANSACTION',
         'Giao dịch ' || format('{:,}', CAST(round(amount, 0) AS BIGINT)) || ' VND đã bị hoàn tiền.',
         processed_at FROM results WHERE status = 'REVERSED')
"""


@register("stream_notifications", _NOTIF + """
SELECT transaction_id, user_id, type, message, created_at, false AS is_read FROM notif""")
def q_stream_notifications(spark, sf_dir):
    """Every result event comes twice; it gives its notifications once."""
    return _streamed(spark, sf_dir, lambda r: events.notification_rows(pipeline.stream_results_once(r)),
                     "notifications", copies=2)


@register("notification_query", _NOTIF + """
SELECT transaction_id, user_id, type, message, created_at, position, total_elements,
       CAST(ceil(total_elements / 20.0) AS BIGINT) AS total_pages FROM (
  SELECT *, count(*) OVER (PARTITION BY user_id) AS total_elements, CAST(row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, transaction_id DESC, type)
                 - 1 AS BIGINT) AS position
  FROM notif) WHERE position < 20""")
def q_notification_query(spark, sf_dir):
    from remitlens.operators.lookups import notification_query
    n = events.notification_rows(_results(spark, sf_dir))
    return notification_query(n, page=0, size=20).select("transaction_id", "user_id", "type", "message",
                                                         "created_at", "position", "total_elements", "total_pages")
