"""Registered queries: one per operator of the inventory, each with a DuckDB oracle.

Conventions shared with the oracles: money is summed as decimal(18,2) and cast
to double in the last projection; counts and other integers are bigint.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from remitlens.operators import facts, flow
from remitlens.plans.model_frames import Frames
from remitlens.plans.registry import register


def _money(c):
    return F.col(c).cast("double").alias(c)


# ---------------------------------------------------------------- facts / joins

@register("fact_geo_explode", """
SELECT transaction_id, owner_user_id, owner_account_id, direction, counterparty_account_id,
       CAST(amount AS DOUBLE) AS amount, status, created_at, province, district,
       CAST(year AS BIGINT) AS year, quarter, month
FROM fact""")
def q_fact_geo_explode(spark, sf_dir):
    f = Frames(spark, sf_dir).fact
    return f.select("transaction_id", "owner_user_id", "owner_account_id", "direction",
                    "counterparty_account_id", _money("amount"), "status", "created_at", "province",
                    "district", F.col("year").cast("bigint").alias("year"), "quarter", "month")


@register("flow_join", """
SELECT o.transaction_id, o.province AS from_province, i.province AS to_province,
       CAST(o.amount AS DOUBLE) AS amount
FROM fact o JOIN fact i ON o.transaction_id = i.transaction_id
WHERE o.direction = 'OUT' AND i.direction = 'IN'""")
def q_flow_join(spark, sf_dir):
    return facts.flow_join(Frames(spark, sf_dir).fact).select(
        "transaction_id", "from_province", "to_province", _money("amount"))


@register("province_flow", """
SELECT o.province AS from_province, i.province AS to_province, CAST(SUM(o.amount) AS DOUBLE) AS total
FROM fact o JOIN fact i ON o.transaction_id = i.transaction_id
WHERE o.direction = 'OUT' AND i.direction = 'IN'
GROUP BY o.province, i.province
ORDER BY total DESC, from_province, to_province
LIMIT 5""")
def q_province_flow(spark, sf_dir):
    return flow.province_flow(Frames(spark, sf_dir).fact, top_n=5)


# ---------------------------------------------------------------- district risk

from remitlens.operators import density, growth, history, peak, recipients, risk, vip  # noqa: E402

RISK_YEAR, RISK_QUARTER = 2024, "Q1"
# Thresholds sized for this data (amounts are small): value ≥ 50, ≥ 2 per hour.
RISK_PARAMS = dict(large_threshold=50, large_min_per_hour=2)

_RISK_BASE = """
, base AS (
  SELECT CASE WHEN district IS NULL OR trim(district) = '' THEN 'UNKNOWN' ELSE trim(district) END AS district,
         upper(trim(status)) AS st, upper(trim(direction)) AS dir, CAST(owner_account_id AS VARCHAR) AS account,
         CAST(counterparty_account_id AS VARCHAR) AS counterparty, amount, created_at
  FROM fact WHERE year = 2024 AND quarter = 'Q1' AND amount IS NOT NULL),
counts AS (
  SELECT district, count(*) AS total, count(*) FILTER (WHERE st IN ('FAILED', 'REVERSED')) AS failed,
         count(*) FILTER (WHERE st = 'REVERSED') AS reversed
  FROM base GROUP BY district),
large AS (
  SELECT district, sum(c) AS large_amount FROM (
    SELECT district, account, date_trunc('hour', created_at) AS h, count(*) AS c
    FROM base WHERE dir = 'OUT' AND amount >= 50 AND created_at IS NOT NULL GROUP BY district, account, h) WHERE c >= 2 GROUP BY district),
rapid AS (
  SELECT district, sum(c) AS rapid_fire FROM (
    SELECT district, account, date_trunc('minute', created_at) AS m, count(*) AS c
    FROM base WHERE dir = 'OUT' AND created_at IS NOT NULL GROUP BY district, account, m) WHERE c >= 2 GROUP BY district),
fan AS (
  SELECT district, count(*) AS fan_out FROM (
    SELECT DISTINCT district, account, date_trunc('hour', created_at) AS h, counterparty
    FROM base WHERE dir = 'OUT' AND created_at IS NOT NULL) GROUP BY district),
measures AS (
  SELECT c.district, c.total, c.failed, c.reversed, coalesce(l.large_amount, 0) AS large_amount,
         coalesce(r.rapid_fire, 0) AS rapid_fire, coalesce(f.fan_out, 0) AS fan_out
  FROM counts c LEFT JOIN large l USING (district) LEFT JOIN rapid r USING (district)
  LEFT JOIN fan f USING (district)),
rated AS (
  SELECT *, floor(CAST(failed AS DOUBLE) * 10000.0 / total + 0.5) / 100.0 AS fail_rate,
         floor(CAST(reversed AS DOUBLE) * 10000.0 / total + 0.5) / 100.0 AS reversal_rate
  FROM measures),
risk AS (
  SELECT district, CAST(total AS BIGINT) AS total, CAST(failed AS BIGINT) AS failed,
         CAST(reversed AS BIGINT) AS reversed, CAST(large_amount AS BIGINT) AS large_amount,
         CAST(rapid_fire AS BIGINT) AS rapid_fire, CAST(fan_out AS BIGINT) AS fan_out, fail_rate, reversal_rate,
         CASE WHEN fail_rate >= 20 OR reversal_rate >= 15 OR rapid_fire > 0 OR fan_out >= 5 OR large_amount > 0
                THEN 'CAO'
              WHEN fail_rate >= 10 OR reversal_rate >= 5 OR large_amount >= 2 OR fan_out >= 2 THEN 'TRUNG_BINH'
              ELSE 'THAP' END AS risk_level
  FROM rated)
"""


def _risk_fact(spark, sf_dir):
    return risk.quarter_slice(Frames(spark, sf_dir).fact, RISK_YEAR, RISK_QUARTER)


@register("district_total", _RISK_BASE + "SELECT district, CAST(total AS BIGINT) AS total FROM counts")
def q_district_total(spark, sf_dir):
    return risk.district_counts(_risk_fact(spark, sf_dir)).select(
        "district", F.col("total").cast("bigint").alias("total"))


@register("district_failed", _RISK_BASE + "SELECT district, CAST(failed AS BIGINT) AS failed FROM counts")
def q_district_failed(spark, sf_dir):
    return risk.district_counts(_risk_fact(spark, sf_dir)).select(
        "district", F.col("failed").cast("bigint").alias("failed"))


@register("district_reversed", _RISK_BASE + "SELECT district, CAST(reversed AS BIGINT) AS reversed FROM counts")
def q_district_reversed(spark, sf_dir):
    return risk.district_counts(_risk_fact(spark, sf_dir)).select(
        "district", F.col("reversed").cast("bigint").alias("reversed"))


@register("large_amount", _RISK_BASE + "SELECT district, CAST(large_amount AS BIGINT) AS large_amount FROM large")
def q_large_amount(spark, sf_dir):
    return risk.large_amount(_risk_fact(spark, sf_dir), 50, 2).select(
        "district", F.col("large_amount").cast("bigint").alias("large_amount"))


@register("rapid_fire", _RISK_BASE + "SELECT district, CAST(rapid_fire AS BIGINT) AS rapid_fire FROM rapid")
def q_rapid_fire(spark, sf_dir):
    return risk.rapid_fire(_risk_fact(spark, sf_dir)).select(
        "district", F.col("rapid_fire").cast("bigint").alias("rapid_fire"))


@register("fan_out", _RISK_BASE + "SELECT district, CAST(fan_out AS BIGINT) AS fan_out FROM fan")
def q_fan_out(spark, sf_dir):
    return risk.fan_out(_risk_fact(spark, sf_dir)).select(
        "district", F.col("fan_out").cast("bigint").alias("fan_out"))


@register("district_risk", _RISK_BASE + "SELECT * FROM risk")
def q_district_risk(spark, sf_dir):
    return risk.district_risk(_risk_fact(spark, sf_dir), **RISK_PARAMS)


@register("district_risk_csv", _RISK_BASE.replace(
    "amount, created_at\n", "amount, CASE WHEN transaction_id % 4 > 0 THEN date_trunc('second', created_at) END AS created_at\n"
) + "SELECT * FROM risk")
def q_district_risk_csv(spark, sf_dir):
    """The report from the text store by the strict time rule: every fourth
    transfer has a fraction of a second, which the rule doesn't read."""
    from remitlens.session import scratch_path
    from remitlens.sources import fact_store
    second = F.date_trunc("second", "created_at")
    fraction = F.when(F.col("transaction_id") % 4 == 0, F.expr("interval 5 microseconds")).otherwise(
        F.expr("interval 0 microseconds"))
    path = scratch_path(spark, "strict-times")
    fact_store.write_fact_partitioned(
        Frames(spark, sf_dir).fact.withColumn("created_at", second + fraction), path, fmt="csv")
    fact = fact_store.scan_fact_csv(spark, path).where((F.col("year") == RISK_YEAR) & (F.col("quarter") == RISK_QUARTER))
    return risk.district_risk(risk.strict_times(fact), **RISK_PARAMS)


@register("risk_sort", _RISK_BASE + """
SELECT district, risk_level, fail_rate,
       CAST(row_number() OVER (ORDER BY CASE risk_level WHEN 'CAO' THEN 3 WHEN 'TRUNG_BINH' THEN 2 ELSE 1 END DESC,
                               fail_rate DESC, district) AS BIGINT) AS position
FROM risk""")
def q_risk_sort(spark, sf_dir):
    from pyspark.sql import Window
    from remitlens.functions import scalars as S
    r = risk.district_risk(_risk_fact(spark, sf_dir), **RISK_PARAMS)
    w = Window.orderBy(S.risk_score(F.col("risk_level")).desc(), F.desc("fail_rate"), "district")
    return r.select("district", "risk_level", "fail_rate", F.row_number().over(w).cast("bigint").alias("position"))


@register("district_cards", _RISK_BASE + """
SELECT CAST(count(*) AS BIGINT) AS district_count, CAST(sum(total) AS BIGINT) AS total_transactions,
       arg_min(district, (CASE risk_level WHEN 'CAO' THEN -3 WHEN 'TRUNG_BINH' THEN -2 ELSE -1 END,
                          -fail_rate, district)) AS worst_district
FROM risk""")
def q_district_cards(spark, sf_dir):
    return risk.district_cards(risk.district_risk(_risk_fact(spark, sf_dir), **RISK_PARAMS))


# ---------------------------------------------------------------- density

_DENSITY = """
, dens AS (
  SELECT CASE WHEN province IS NULL OR trim(province) = '' THEN 'UNKNOWN' ELSE trim(province) END AS province,
         count(*) AS n
  FROM fact WHERE year = 2024 AND quarter = 'Q1' GROUP BY 1)
"""


@register("province_density", _DENSITY + "SELECT province, CAST(n AS BIGINT) AS n FROM dens")
def q_province_density(spark, sf_dir):
    d = density.province_density(_risk_fact(spark, sf_dir))
    return d.select("province", F.col("n").cast("bigint").alias("n"))


@register("density_rank", _DENSITY + """
SELECT province, CAST(n AS BIGINT) AS n, CAST(row_number() OVER (ORDER BY n DESC, province) AS BIGINT) AS rank
FROM dens""")
def q_density_rank(spark, sf_dir):
    return density.density_rank(density.province_density(_risk_fact(spark, sf_dir)))


@register("density_share", _DENSITY + """
SELECT province, CAST(n AS BIGINT) AS n, round(n * 100.0 / max(n) OVER (), 2) AS pct_of_max FROM dens""")
def q_density_share(spark, sf_dir):
    return density.density_share(density.province_density(_risk_fact(spark, sf_dir)))


# ---------------------------------------------------------------- peak hours / days

PEAK_MONTH = "2024-01"

_PEAK = """
, pk AS (
  SELECT hour(created_at) AS hour, day(created_at) AS day, owner_user_id, owner_account_id, amount
  FROM fact WHERE upper(trim(direction)) = 'OUT' AND upper(trim(status)) IN ('SUCCESS', 'COMPLETED')
    AND trim(month) = '2024-01' AND amount IS NOT NULL AND created_at IS NOT NULL),
tot AS (
  SELECT CASE grouping(hour, day, owner_user_id, owner_account_id)
           WHEN 7 THEN 'HOUR_TOTAL' WHEN 4 THEN 'HOUR_USER' WHEN 11 THEN 'DAY_TOTAL' WHEN 8 THEN 'DAY_USER' END
           AS level, hour, day, owner_user_id, owner_account_id, count(*) AS n, sum(amount) AS amount
  FROM pk
  GROUP BY GROUPING SETS ((hour), (hour, owner_user_id, owner_account_id), (day), (day, owner_user_id, owner_account_id))),
peak_hour AS (SELECT hour AS k, n, amount FROM tot WHERE level = 'HOUR_TOTAL' ORDER BY n DESC, amount DESC, hour LIMIT 1),
peak_day AS (SELECT day AS k, n, amount FROM tot WHERE level = 'DAY_TOTAL' ORDER BY n DESC, amount DESC, day LIMIT 1)
"""


@register("peak_totals", _PEAK + """
SELECT level, hour, day, owner_user_id, owner_account_id, n, amount FROM tot""")
def q_peak_totals(spark, sf_dir):
    t = peak.peak_totals(Frames(spark, sf_dir).fact, PEAK_MONTH)
    return t.select("level", F.col("hour").cast("bigint").alias("hour"), F.col("day").cast("bigint").alias("day"),
                    "owner_user_id", "owner_account_id", F.col("n").cast("bigint").alias("n"),
                    F.col("amount").cast("double").alias("amount"))


_PEAK_TOTALS_SQL_FIX = None


@register("peak_window", _PEAK + """
SELECT 'HOUR' AS kind, CAST(k AS BIGINT) AS key, printf('%02d:00 - %02d:59', k, k) AS label,
       CAST(n AS BIGINT) AS total_transactions, CAST(amount AS DOUBLE) AS total_amount FROM peak_hour
UNION ALL
SELECT 'DAY', CAST(k AS BIGINT), printf('Ngày %02d', k), CAST(n AS BIGINT), CAST(amount AS DOUBLE) FROM peak_day""")
def q_peak_window(spark, sf_dir):
    return peak.peak_window(spark, peak.peak_totals(Frames(spark, sf_dir).fact, PEAK_MONTH, peak.TOTAL_LEVELS))


@register("hourly_chart", _PEAK + """
SELECT CAST(h.hour AS BIGINT) AS hour, printf('%02d:00 - %02d:59', h.hour, h.hour) AS label,
       CAST(coalesce(t.n, 0) AS BIGINT) AS total_transactions, CAST(coalesce(t.amount, 0) AS DOUBLE) AS total_amount
FROM range(24) h(hour) LEFT JOIN (SELECT hour, n, amount FROM tot WHERE level = 'HOUR_TOTAL') t USING (hour)""")
def q_hourly_chart(spark, sf_dir):
    return peak.hourly_chart(spark, peak.peak_totals(Frames(spark, sf_dir).fact, PEAK_MONTH, ("HOUR_TOTAL",)))


@register("daily_chart", _PEAK + """
SELECT CAST(d.day AS BIGINT) AS day, printf('Ngày %02d', d.day) AS label,
       CAST(coalesce(t.n, 0) AS BIGINT) AS total_transactions, CAST(coalesce(t.amount, 0) AS DOUBLE) AS total_amount
FROM range(1, 32) d(day) LEFT JOIN (SELECT day, n, amount FROM tot WHERE level = 'DAY_TOTAL') t USING (day)""")
def q_daily_chart(spark, sf_dir):
    return peak.daily_chart(spark, peak.peak_totals(Frames(spark, sf_dir).fact, PEAK_MONTH, ("DAY_TOTAL",)),
                            PEAK_MONTH)


@register("top_users_peak", _PEAK + """
, hu AS (SELECT 'HOUR' AS kind, t.hour AS key, t.owner_user_id, t.owner_account_id, t.n, t.amount
         FROM tot t JOIN peak_hour p ON t.hour = p.k WHERE t.level = 'HOUR_USER'
         ORDER BY t.n DESC, t.amount DESC, t.owner_user_id LIMIT 10),
du AS (SELECT 'DAY' AS kind, t.day AS key, t.owner_user_id, t.owner_account_id, t.n, t.amount
       FROM tot t JOIN peak_day p ON t.day = p.k WHERE t.level = 'DAY_USER'
       ORDER BY t.n DESC, t.amount DESC, t.owner_user_id LIMIT 10)
SELECT x.kind, CAST(x.key AS BIGINT) AS key, x.owner_user_id AS user_id,
       coalesce(u.full_name, 'User ' || substr(CAST(x.owner_user_id AS VARCHAR), 1, 8)) AS full_name,
       x.owner_account_id AS account_number, CAST(x.n AS BIGINT) AS total_transactions,
       CAST(x.amount AS DOUBLE) AS total_amount
FROM (SELECT * FROM hu UNION ALL SELECT * FROM du) x LEFT JOIN users u ON u.user_id = x.owner_user_id""")
def q_top_users_peak(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    return peak.top_users_peak(spark, fr.fact, PEAK_MONTH, fr.users)


# ---------------------------------------------------------------- quarterly growth (history data)

GROWTH_YEAR = 1997

_TX_FACT = """
, txgeo AS (
  SELECT t.transaction_id, t.amount, t.status, t.created_at,
         u.user_id AS from_user_id, u.account_number AS from_account, u.province AS from_province,
         u.district AS from_district, v.user_id AS to_user_id, v.account_number AS to_account,
         v.province AS to_province, v.district AS to_district
  FROM tx t JOIN users u ON u.user_id = t.from_id JOIN users v ON v.user_id = t.to_id),
txfact AS (
  SELECT transaction_id, from_user_id AS owner_user_id, 'OUT' AS direction, amount, status, created_at,
         from_province AS province, year(created_at) AS year, 'Q' || quarter(created_at) AS quarter
  FROM txgeo
  UNION ALL
  SELECT transaction_id, to_user_id, 'IN', amount, status, created_at, to_province,
         year(created_at), 'Q' || quarter(created_at)
  FROM txgeo)
, qs AS (
  SELECT quarter, sum(amount) AS total_amount, count(*) AS tx_count,
         count(*) FILTER (WHERE upper(status) = 'SUCCESS') AS success_count
  FROM txfact WHERE CAST(year AS VARCHAR) = '1997' AND amount IS NOT NULL AND status IS NOT NULL AND status <> ''
    AND quarter IN ('Q1', 'Q2')
  GROUP BY quarter)
"""


@register("quarter_stats", _TX_FACT + """
SELECT CAST(1997 AS BIGINT) AS year, quarter, CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(tx_count AS BIGINT) AS tx_count, CAST(success_count AS BIGINT) AS success_count,
       CAST(tx_count - success_count AS BIGINT) AS fail_count,
       floor((CAST(success_count AS DOUBLE) * 100.0 / tx_count) * 100.0 + 0.5) / 100.0 AS success_rate
FROM qs""")
def q_quarter_stats(spark, sf_dir):
    return growth.quarter_stats(Frames(spark, sf_dir).tx_fact, GROWTH_YEAR)


@register("quarter_growth", _TX_FACT + """
, p AS (
  SELECT CAST(max(total_amount) FILTER (WHERE quarter = 'Q1') AS DOUBLE) AS a1,
         CAST(max(total_amount) FILTER (WHERE quarter = 'Q2') AS DOUBLE) AS a2,
         CAST(max(tx_count) FILTER (WHERE quarter = 'Q1') AS DOUBLE) AS c1,
         CAST(max(tx_count) FILTER (WHERE quarter = 'Q2') AS DOUBLE) AS c2
  FROM qs)
SELECT CAST(1997 AS BIGINT) AS year,
       CASE WHEN a1 > 0 THEN floor(((a2 - a1) / a1 * 100) * 100.0 + 0.5) / 100.0 ELSE 0.0 END AS growth_amount_pct,
       CASE WHEN c1 > 0 THEN floor(((c2 - c1) / c1 * 100) * 100.0 + 0.5) / 100.0 ELSE 0.0 END AS growth_count_pct
FROM p WHERE a1 IS NOT NULL AND a2 IS NOT NULL""")
def q_quarter_growth(spark, sf_dir):
    return growth.quarter_growth(growth.quarter_stats(Frames(spark, sf_dir).tx_fact, GROWTH_YEAR))


from remitlens.plans import cat_users  # noqa: E402,F401
from remitlens.plans import cat_io, cat_ledger  # noqa: E402,F401
from remitlens.plans import cat_scalars  # noqa: E402,F401
from remitlens.plans import cat_stream  # noqa: E402,F401
from remitlens.plans import cat_extra  # noqa: E402,F401
