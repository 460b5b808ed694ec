"""Registered dashboard derivations, period ranges and name enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from remitlens.functions import ranges
from remitlens.operators import flow, recipients, risk
from remitlens.operators.peak import fallback_user_name
from remitlens.plans.catalog import RISK_PARAMS, _risk_fact
from remitlens.plans.model_frames import Frames
from remitlens.plans.registry import register

_FLOWS = """
, flows AS (
  SELECT o.province AS from_province, i.province AS to_province, sum(o.amount) AS total
  FROM fact o JOIN fact i ON o.transaction_id = i.transaction_id
  WHERE o.direction = 'OUT' AND i.direction = 'IN'
  GROUP BY o.province, i.province)
"""


@register("top_flows", _FLOWS + """
SELECT from_province, to_province, CAST(total AS DOUBLE) AS total FROM flows
ORDER BY total DESC, from_province, to_province LIMIT 20""")
def q_top_flows(spark, sf_dir):
    return flow.province_flow(Frames(spark, sf_dir).fact, top_n=20)


@register("flow_share", _FLOWS + """
, top AS (SELECT * FROM flows ORDER BY total DESC, from_province, to_province LIMIT 20)
SELECT from_province, to_province, CAST(total AS DOUBLE) AS total,
       round(CAST(total AS DOUBLE) * 100.0 / max(CAST(total AS DOUBLE)) OVER (), 2) AS pct_of_max,
       round(CAST(total AS DOUBLE) * 100.0 / sum(CAST(total AS DOUBLE)) OVER (), 2) AS pct_of_total
FROM top""")
def q_flow_share(spark, sf_dir):
    return flow.flow_share(flow.province_flow(Frames(spark, sf_dir).fact, top_n=20))


@register("risk_level", """
, base AS (
  SELECT CASE WHEN district IS NULL OR trim(district) = '' THEN 'UNKNOWN' ELSE trim(district) END AS district,
         upper(trim(status)) AS st, upper(trim(direction)) AS dir, CAST(owner_account_id AS VARCHAR) AS account,
         CAST(counterparty_account_id AS VARCHAR) AS counterparty, amount, created_at
  FROM fact WHERE year = 2024 AND quarter = 'Q1' AND amount IS NOT NULL),
counts AS (
  SELECT district, count(*) AS total, count(*) FILTER (WHERE st IN ('FAILED', 'REVERSED')) AS failed,
         count(*) FILTER (WHERE st = 'REVERSED') AS reversed FROM base GROUP BY district),
large AS (
  SELECT district, sum(c) AS large_amount FROM (
    SELECT district, account, date_trunc('hour', created_at) AS h, count(*) AS c
    FROM base WHERE dir = 'OUT' AND amount >= 50 GROUP BY ALL) WHERE c >= 2 GROUP BY district),
rapid AS (
  SELECT district, sum(c) AS rapid_fire FROM (
    SELECT district, account, date_trunc('minute', created_at) AS m, count(*) AS c
    FROM base WHERE dir = 'OUT' GROUP BY ALL) WHERE c >= 2 GROUP BY district),
fan AS (
  SELECT district, count(*) AS fan_out FROM (
    SELECT DISTINCT district, account, date_trunc('hour', created_at) AS h, counterparty FROM base WHERE dir = 'OUT')
  GROUP BY district),
r AS (
  SELECT c.district, floor(CAST(failed AS DOUBLE) * 10000.0 / total + 0.5) / 100.0 AS fail_rate,
         floor(CAST(reversed AS DOUBLE) * 10000.0 / total + 0.5) / 100.0 AS reversal_rate,
         coalesce(l.large_amount, 0) AS large_amount, coalesce(p.rapid_fire, 0) AS rapid_fire,
         coalesce(f.fan_out, 0) AS fan_out
  FROM counts c LEFT JOIN large l USING (district) LEFT JOIN rapid p USING (district) LEFT JOIN fan f USING (district))
SELECT district,
       CASE WHEN fail_rate >= 20 OR reversal_rate >= 15 OR rapid_fire > 0 OR fan_out >= 5 OR large_amount > 0 THEN 'CAO'
            WHEN fail_rate >= 10 OR reversal_rate >= 5 OR large_amount >= 2 OR fan_out >= 2 THEN 'TRUNG_BINH'
            ELSE 'THAP' END AS risk_level
FROM r""")
def q_risk_level(spark, sf_dir):
    return risk.district_risk(_risk_fact(spark, sf_dir), **RISK_PARAMS).select("district", "risk_level")


@register("enrich_user_name", """
, top AS (
  SELECT from_id AS from_account, sum(amount) AS total_amount FROM tx
  WHERE strftime(created_at, '%Y-%m') BETWEEN '1997-01' AND '1997-12' GROUP BY 1
  ORDER BY total_amount DESC, from_account LIMIT 10)
SELECT t.from_account AS user_id, coalesce(u.full_name, 'User ' || substr(CAST(t.from_account AS VARCHAR), 1, 8))
         AS full_name, CAST(t.total_amount AS DOUBLE) AS total_amount
FROM top t LEFT JOIN users u ON u.user_id = t.from_account""")
def q_enrich_user_name(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    monthly = recipients.month_window(fr.tx, "1997-01", "1997-12").select(
        F.date_format("created_at", "yyyy-MM").alias("month"), F.col("from_id").alias("from_account"), "amount")
    top = recipients.top_accounts(recipients.total_by_account(monthly), "1997-01", "1997-12", k=10)
    # ≤ 10 ids: broadcast them to filter the user dimension, then join back.
    ids = top.select(F.col("from_account").alias("user_id"))
    names = fr.users.select("user_id", "full_name").join(F.broadcast(ids), "user_id")
    return (top.withColumnRenamed("from_account", "user_id").join(F.broadcast(names), "user_id", "left")
            .select("user_id", F.coalesce("full_name", fallback_user_name(F.col("user_id"))).alias("full_name"),
                    "total_amount"))


_RANGES = """
, labelled AS (
  SELECT DISTINCT 'day' AS granularity, strftime(created_at, '%Y-%m-%d') AS label, date_trunc('day', created_at) AS s,
         INTERVAL 1 DAY AS step FROM tx
  UNION ALL
  SELECT DISTINCT 'week', strftime(created_at, '%G-W%V'), date_trunc('week', created_at), INTERVAL 7 DAY FROM tx
  UNION ALL
  SELECT DISTINCT 'month', strftime(created_at, '%Y-%m'), date_trunc('month', created_at), INTERVAL 1 MONTH FROM tx
  UNION ALL
  SELECT DISTINCT 'quarter', strftime(created_at, '%Y') || '-Q' || quarter(created_at),
         date_trunc('quarter', created_at), INTERVAL 3 MONTH FROM tx
  UNION ALL
  SELECT DISTINCT 'year', strftime(created_at, '%Y'), date_trunc('year', created_at), INTERVAL 1 YEAR FROM tx)
"""


@register("range_by_granularity", _RANGES + """
SELECT granularity, label, CAST(s AS TIMESTAMP) AS range_start,
       CAST(s + step - INTERVAL 1 SECOND AS TIMESTAMP) AS range_end FROM labelled""")
def q_range_by_granularity(spark, sf_dir):
    tx = Frames(spark, sf_dir).tx
    grains = ("day", "week", "month", "quarter", "year")
    # One scan: every row emits its five labels, and one distinct (partially
    # aggregated map-side) keeps each (granularity, label) once.
    per_row = F.array(*[F.struct(F.lit(g).alias("granularity"), ranges.label_of(F.col("created_at"), g)
                                 .alias("label")) for g in grains])
    labels = tx.select(F.explode(per_row).alias("p")).select("p.granularity", "p.label").distinct()
    start = end = None
    for g in grains:
        s, e = ranges.range_by_granularity(F.col("label"), g)
        is_g = F.col("granularity") == g
        start = F.when(is_g, s) if start is None else start.when(is_g, s)
        end = F.when(is_g, e) if end is None else end.when(is_g, e)
    return labels.select("granularity", "label", start.alias("range_start"), end.alias("range_end"))


@register("export_join", """
SELECT transaction_id, from_user_id, from_account, from_name, from_province, from_district, to_user_id, to_account,
       to_name, to_province, to_district, CAST(amount AS DOUBLE) AS amount, status, created_at FROM geo""")
def q_export_join(spark, sf_dir):
    g = Frames(spark, sf_dir).geo
    return g.select("transaction_id", "from_user_id", "from_account", "from_name", "from_province", "from_district",
                    "to_user_id", "to_account", "to_name", "to_province", "to_district",
                    F.col("amount").cast("double").alias("amount"), "status", "created_at")
