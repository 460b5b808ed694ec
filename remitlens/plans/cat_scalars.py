"""Registered scalar-function queries. Inputs are the driver tables or
variants Spark derives from them (padded / lower-cased statuses, ISO strings
of several shapes, JSON wrapped in a JSON string), so each function meets the
quirks it exists for while the work still scales with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from remitlens.functions import scalars as S
from remitlens.plans.model_frames import Frames
from remitlens.plans.registry import register

_SRC, _DST = S.vietnamese_letter_map()


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ---------------------------------------------------------------- text

@register("normalize_location", r"""
, src AS (SELECT doc_id, text FROM documents),
cleaned AS (
  SELECT doc_id, text,
         trim(regexp_replace(regexp_replace(replace(replace(strip_accents(
             regexp_replace(text, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')), 'Đ', 'D'), 'đ', 'd'),
             '[^a-zA-Z\s]', '', 'g'), '\s+', ' ', 'g')) AS words
  FROM src)
SELECT doc_id,
       CASE WHEN text IS NULL OR regexp_replace(text, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') = '' THEN 'Unknown'
            ELSE array_to_string(list_transform(string_split(words, ' '),
                                                lambda w: upper(w[1]) || lower(w[2:])), '') END AS normalized
FROM cleaned""")
def q_normalize_location(spark, sf_dir):
    d = Frames(spark, sf_dir).table("documents")
    return d.select("doc_id", S.normalize_location(F.col("text")).alias("normalized"))


@register("non_accent", f"""
SELECT doc_id, translate(text, {_sql_str(_SRC)}, {_sql_str(_DST)}) AS plain FROM documents""")
def q_non_accent(spark, sf_dir):
    d = Frames(spark, sf_dir).table("documents")
    return d.select("doc_id", S.non_accent(F.col("text")).alias("plain"))


# ---------------------------------------------------------------- status

_RAW_STATUS = """
, raw AS (
  SELECT transaction_id,
         CASE transaction_id % 4 WHEN 0 THEN lower(status) WHEN 1 THEN ' ' || status || ' ' WHEN 2 THEN ''
              ELSE status END AS raw_status
  FROM etx)
"""


def _raw_status(spark, sf_dir):
    e = Frames(spark, sf_dir).etx
    m = F.col("transaction_id") % 4
    raw = (F.when(m == 0, F.lower("status")).when(m == 1, F.concat(F.lit(" "), F.col("status"), F.lit(" ")))
           .when(m == 2, F.lit("")).otherwise(F.col("status")))
    return e.select("transaction_id", raw.alias("raw_status"))


@register("status_norm", _RAW_STATUS + """
SELECT transaction_id, raw_status, coalesce(nullif(upper(trim(raw_status)), ''), 'UNKNOWN') AS status FROM raw""")
def q_status_norm(spark, sf_dir):
    r = _raw_status(spark, sf_dir)
    return r.select("transaction_id", "raw_status", S.status_norm(F.col("raw_status")).alias("status"))


@register("is_success", _RAW_STATUS + """
SELECT transaction_id, coalesce(nullif(upper(trim(raw_status)), ''), 'UNKNOWN') IN ('SUCCESS', 'COMPLETED') AS ok
FROM raw""")
def q_is_success(spark, sf_dir):
    r = _raw_status(spark, sf_dir)
    return r.select("transaction_id", S.is_success(F.col("raw_status")).alias("ok"))


# ---------------------------------------------------------------- time

@register("period_label", """
SELECT transaction_id, strftime(created_at, '%Y-%m-%d') AS day_label, strftime(created_at, '%m/%Y') AS month_label,
       'Q' || quarter(created_at) || '/' || year(created_at) AS quarter_label, strftime(created_at, '%Y') AS year_label
FROM tx""")
def q_period_label(spark, sf_dir):
    t = Frames(spark, sf_dir).tx
    ts = F.col("created_at")
    return t.select("transaction_id", S.period_label(ts, "day").alias("day_label"),
                    S.period_label(ts, "month").alias("month_label"),
                    S.period_label(ts, "quarter").alias("quarter_label"),
                    S.period_label(ts, "year").alias("year_label"))


@register("quarter_of", """
SELECT transaction_id, 'Q' || quarter(created_at) AS quarter, strftime(created_at, '%Y-%m') AS month FROM tx""")
def q_quarter_of(spark, sf_dir):
    t = Frames(spark, sf_dir).tx
    return t.select("transaction_id", S.quarter_of(F.col("created_at")).alias("quarter"),
                    S.month_of(F.col("created_at")).alias("month"))


@register("hour_day_of", """
SELECT transaction_id, CAST(hour(created_at) AS BIGINT) AS hour, CAST(day(created_at) AS BIGINT) AS day FROM etx""")
def q_hour_day_of(spark, sf_dir):
    e = Frames(spark, sf_dir).etx
    return e.select("transaction_id", S.hour_of(F.col("created_at")).cast("bigint").alias("hour"),
                    S.day_of(F.col("created_at")).cast("bigint").alias("day"))


@register("ts_parse", """
SELECT transaction_id,
       CASE transaction_id % 4 WHEN 0 THEN created_at WHEN 1 THEN date_trunc('minute', created_at)
            WHEN 2 THEN date_trunc('second', created_at) END AS lenient,
       CASE WHEN transaction_id % 4 = 2 THEN date_trunc('second', created_at) END AS strict
FROM etx""")
def q_ts_parse(spark, sf_dir):
    e = Frames(spark, sf_dir).etx
    m = F.col("transaction_id") % 4
    ts = F.col("created_at")
    text = (F.when(m == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
            .when(m == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm"))
            .when(m == 2, F.concat(F.lit(" "), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")))
            .otherwise(F.lit("bad")))
    return e.select("transaction_id", S.ts_parse(text).alias("lenient"), S.ts_parse(text, strict=True).alias("strict"))


# ---------------------------------------------------------------- numbers

@register("amount_parse", """
SELECT transaction_id,
       CASE WHEN transaction_id % 3 = 2 THEN NULL ELSE CAST(amount AS DOUBLE) END AS parsed
FROM etx""")
def q_amount_parse(spark, sf_dir):
    e = Frames(spark, sf_dir).etx
    m = F.col("transaction_id") % 3
    text = (F.when(m == 0, F.col("amount").cast("string"))
            .when(m == 1, F.concat(F.lit("  "), F.col("amount").cast("string"), F.lit(" ")))
            .otherwise(F.concat(F.lit("x"), F.col("amount").cast("string"))))
    return e.select("transaction_id", S.amount_parse(text).cast("double").alias("parsed"))


@register("round2_java", """
SELECT transaction_id, floor(((CAST(amount AS DOUBLE) - 250.0) / 8.0) * 100 + 0.5) / 100.0 AS r FROM etx""")
def q_round2_java(spark, sf_dir):
    e = Frames(spark, sf_dir).etx
    x = (F.col("amount").cast("double") - 250.0) / 8.0
    return e.select("transaction_id", S.round2_java(x).alias("r"))


@register("money_format", """
SELECT transaction_id, format('{:,}', CAST(round(amount * 1000, 0) AS BIGINT)) || ' VND' AS text FROM etx""")
def q_money_format(spark, sf_dir):
    e = Frames(spark, sf_dir).etx
    return e.select("transaction_id", S.money_format(F.col("amount") * 1000).alias("text"))


@register("json_unwrap", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def q_json_unwrap(spark, sf_dir):
    ev = Frames(spark, sf_dir).table("events")
    wrapped = F.when(F.col("event_id") % 2 == 0, F.to_json(F.array(F.col("props"))).substr(F.lit(2), F.length(
        F.to_json(F.array(F.col("props")))) - 2)).otherwise(F.col("props"))
    parsed = F.from_json(S.json_unwrap(wrapped), "k INT")
    return ev.select("event_id", parsed.getField("k").alias("k"))
