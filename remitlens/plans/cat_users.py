"""Registered per-user queries: VIP, history, statistics, monthly statements,
recipients and account totals (history transfers ``tx``, intraday ``fact``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from remitlens.operators import history, recipients, vip
from remitlens.plans.model_frames import Frames
from remitlens.plans.registry import register
from remitlens.session import scratch_path
from remitlens.sources import fact_store, history_table, stores

VIP_YEAR = 1997
HIST_START, HIST_END = dt.datetime(1997, 1, 1), dt.datetime(1997, 12, 31, 23, 59, 59)
ACCT_START, ACCT_END = dt.datetime(1998, 1, 1), dt.datetime(1999, 1, 1)
STATEMENT_MONTH = "1997-05"


def _d(c):
    return F.col(c).cast("double").alias(c)


def _b(c):
    return F.col(c).cast("bigint").alias(c)


# ---------------------------------------------------------------- VIP

_VIP = """
, spent AS (
  SELECT from_id, sum(amount) AS paid, count(*) AS n FROM tx
  WHERE status = 'SUCCESS' AND year(created_at) = 1997 GROUP BY from_id),
standing AS (
  SELECT s.from_id, s.paid, s.n, (SELECT count(*) FROM spent x WHERE x.paid < s.paid) AS below,
         (SELECT count(*) FROM spent) AS everyone FROM spent s),
vt AS (
  SELECT p.user_id, p.full_name, c.account_number, w.paid AS total_amount, w.n AS total_txn,
         CASE WHEN w.everyone > 1 THEN w.below / (w.everyone - 1) ELSE 0.0 END AS pct_rank
  FROM standing w JOIN accounts c ON c.account_id = w.from_id JOIN users p ON p.user_id = c.user_id)
"""


def _vip_totals(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    return vip.vip_totals(fr.tx, fr.accounts, fr.users, VIP_YEAR)


@register("vip_totals", _VIP + """
SELECT user_id, full_name, account_number, CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(total_txn AS BIGINT) AS total_txn FROM vt""")
def q_vip_totals(spark, sf_dir):
    return _vip_totals(spark, sf_dir).select("user_id", "full_name", "account_number", _d("total_amount"),
                                             _b("total_txn"))


@register("vip_join", """
SELECT t.transaction_id, u.user_id, u.full_name, a.account_number, CAST(t.amount AS DOUBLE) AS amount, t.status,
       t.created_at
FROM tx t JOIN accounts a ON a.account_id = t.from_id JOIN users u ON u.user_id = a.user_id""")
def q_vip_join(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    a = fr.accounts.select(F.col("account_id").alias("from_id"), "user_id", "account_number")
    u = fr.users.select("user_id", "full_name")
    return (fr.tx.join(a, "from_id").join(u, "user_id")
            .select("transaction_id", "user_id", "full_name", "account_number", _d("amount"), "status",
                    "created_at"))


@register("vip_percent_rank", _VIP + """
SELECT user_id, full_name, account_number, CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(total_txn AS BIGINT) AS total_txn, pct_rank FROM vt WHERE pct_rank >= 0.95""")
def q_vip_percent_rank(spark, sf_dir):
    return vip.vip_percent_rank(_vip_totals(spark, sf_dir)).select(
        "user_id", "full_name", "account_number", _d("total_amount"), _b("total_txn"), "pct_rank")


@register("vip_summary", _VIP + """
SELECT CAST(count(*) AS BIGINT) AS vip_count, CAST(sum(total_amount) AS DOUBLE) AS total_amount,
       CAST(sum(total_txn) AS BIGINT) AS total_transactions,
       CAST(sum(total_amount) AS DOUBLE) / count(*) AS avg_amount
FROM vt WHERE pct_rank >= 0.95""")
def q_vip_summary(spark, sf_dir):
    return vip.vip_summary(vip.vip_percent_rank(_vip_totals(spark, sf_dir)))


# ---------------------------------------------------------------- history

_PARTS = """
, wp AS (
  SELECT t.*, fa.user_id AS from_user, fa.account_number AS from_account_number,
         ta.user_id AS to_user, ta.account_number AS to_account_number
  FROM tx t LEFT JOIN accounts fa ON fa.account_id = t.from_id LEFT JOIN accounts ta ON ta.account_id = t.to_id),
sides AS (
  SELECT transaction_id, from_user AS user_id, 'OUT' AS side, (from_user = to_user) AS is_self,
         to_account_number AS counterparty_account, amount, status, created_at
  FROM wp WHERE from_user IS NOT NULL
  UNION ALL
  SELECT transaction_id, to_user, 'IN', (from_user IS NOT NULL AND from_user = to_user), from_account_number,
         amount, status, created_at
  FROM wp WHERE to_user IS NOT NULL),
parts AS (
  SELECT transaction_id, user_id, CASE WHEN is_self THEN 'SELF' ELSE side END AS direction,
         counterparty_account, amount, status, created_at
  FROM sides WHERE NOT coalesce(is_self AND side = 'IN', false))
"""

_PART_COLS = "transaction_id, user_id, direction, counterparty_account, CAST(amount AS DOUBLE) AS amount, status, created_at"
_HIST_RANGE = "created_at BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-12-31 23:59:59'"


def _parts_out(df):
    return df.select("transaction_id", "user_id", "direction", "counterparty_account", _d("amount"), "status",
                     "created_at")


@register("history_left_join", """
SELECT t.transaction_id, t.from_id, t.to_id, fa.user_id AS from_user, fa.account_number AS from_account_number,
       ta.user_id AS to_user, ta.account_number AS to_account_number, CAST(t.amount AS DOUBLE) AS amount
FROM tx t LEFT JOIN accounts fa ON fa.account_id = t.from_id LEFT JOIN accounts ta ON ta.account_id = t.to_id""")
def q_history_left_join(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    return history.with_parties(fr.tx, fr.accounts).select(
        "transaction_id", "from_id", "to_id", "from_user", "from_account_number", "to_user", "to_account_number",
        _d("amount"))


@register("direction_classify", _PARTS + f"SELECT {_PART_COLS} FROM parts")
def q_direction_classify(spark, sf_dir):
    return _parts_out(Frames(spark, sf_dir).tx_parts)


@register("history_user", _PARTS + f"SELECT {_PART_COLS} FROM parts WHERE {_HIST_RANGE}")
def q_history_user(spark, sf_dir):
    return _parts_out(history.history_user(Frames(spark, sf_dir).tx_parts, HIST_START, HIST_END))


@register("history_status_filter", _PARTS + f"""
SELECT {_PART_COLS} FROM parts WHERE {_HIST_RANGE} AND upper(trim(status)) = 'SUCCESS'""")
def q_history_status_filter(spark, sf_dir):
    h = history.history_user(Frames(spark, sf_dir).tx_parts, HIST_START, HIST_END)
    return _parts_out(history.history_status_filter(h, "success"))


@register("history_cards", _PARTS + f"""
SELECT user_id, CAST(count(*) FILTER (WHERE upper(trim(status)) = 'SUCCESS') AS BIGINT) AS success_count,
       CAST(count(*) FILTER (WHERE upper(trim(status)) = 'PENDING') AS BIGINT) AS pending_count,
       CAST(sum(amount) AS DOUBLE) AS total_amount
FROM parts WHERE {_HIST_RANGE} GROUP BY user_id""")
def q_history_cards(spark, sf_dir):
    return history.history_cards(history.history_user(Frames(spark, sf_dir).tx_parts, HIST_START, HIST_END))


@register("history_account", """
SELECT a.account_id, t.transaction_id, t.from_id, t.to_id, CAST(t.amount AS DOUBLE) AS amount, t.status, t.created_at
FROM tx t JOIN (SELECT DISTINCT account_id FROM accounts) a ON a.account_id = t.from_id OR a.account_id = t.to_id
WHERE t.created_at >= TIMESTAMP '1998-01-01' AND t.created_at < TIMESTAMP '1999-01-01'""")
def q_history_account(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    h = history.history_account(fr.tx, fr.accounts, ACCT_START, ACCT_END)
    return h.select("account_id", "transaction_id", "from_id", "to_id", _d("amount"), "status", "created_at")


@register("pair_filter", """
SELECT t.transaction_id, t.from_id, t.to_id, CAST(t.amount AS DOUBLE) AS amount, t.status, t.created_at
FROM tx t WHERE EXISTS (SELECT 1 FROM tx r WHERE r.from_id = t.to_id AND r.to_id = t.from_id)""")
def q_pair_filter(spark, sf_dir):
    tx = Frames(spark, sf_dir).tx
    reverse = tx.select(F.col("to_id").alias("from_id"), F.col("from_id").alias("to_id"))
    return history.pair_filter(tx, reverse).select("transaction_id", "from_id", "to_id", _d("amount"), "status",
                                                   "created_at")


def _history(spark, sf_dir):
    return stores.once(spark, "history", [f"{sf_dir}/{t}.parquet" for t in ("orders", "customer")],
                       lambda: history_table.create(Frames(spark, sf_dir).tx_parts))


@register("page_history", _PARTS + f"""
, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, transaction_id DESC) AS rn,
         count(*) OVER (PARTITION BY user_id) AS total_elements
  FROM parts)
SELECT {_PART_COLS}, CAST(total_elements AS BIGINT) AS total_elements,
       CAST(ceil(total_elements / 20.0) AS BIGINT) AS total_pages, CAST(rn - 1 AS BIGINT) AS position
FROM ranked WHERE rn <= 20""")
def q_page_history(spark, sf_dir):
    """From the bucketed, sorted history table: no exchange, rows and totals in one read."""
    p = history_table.pages(spark, _history(spark, sf_dir), page=0, size=20)
    return p.select("transaction_id", "user_id", "direction", "counterparty_account", _d("amount"), "status",
                    "created_at", _b("total_elements"), "total_pages", "position")


@register("page_after", _PARTS + f"""
, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, transaction_id DESC) AS rn FROM parts)
SELECT {_PART_COLS}, CAST(CASE WHEN user_id % 2 = 0 THEN rn - 6 ELSE rn - 1 END AS BIGINT) AS position
FROM ranked WHERE CASE WHEN user_id % 2 = 0 THEN rn BETWEEN 6 AND 10 ELSE rn <= 5 END""")
def q_page_after(spark, sf_dir):
    """Second page of five for users with an even id by keyset, first page for the others."""
    parts = Frames(spark, sf_dir).tx_parts
    first = history.page_history(parts, page=0, size=5)
    last = first.where((F.col("position") == 4) & (F.col("user_id") % 2 == 0)).select(
        "user_id", F.col("created_at").alias("last_created_at"), F.col("transaction_id").alias("last_id"))
    # even users with fewer than five rows have no second page
    done = first.where(F.col("user_id") % 2 == 0).join(last, "user_id", "left_anti").select("user_id").distinct()
    p = history.page_after(parts.join(done, "user_id", "left_anti"), last, size=5)
    return p.select("transaction_id", "user_id", "direction", "counterparty_account", _d("amount"), "status",
                    "created_at", "position")


# ---------------------------------------------------------------- statistics

_STATS_COLS = """CAST(count(*) AS BIGINT) AS total_transactions,
       CAST(count(*) FILTER (WHERE coalesce(nullif(upper(trim(status)), ''), 'UNKNOWN') = 'SUCCESS') AS BIGINT) AS success_count,
       CAST(count(*) FILTER (WHERE coalesce(nullif(upper(trim(status)), ''), 'UNKNOWN') = 'PENDING') AS BIGINT) AS pending_count,
       CAST(count(*) FILTER (WHERE coalesce(nullif(upper(trim(status)), ''), 'UNKNOWN') = 'FAILED') AS BIGINT) AS failed_count"""


@register("stats_summary", _PARTS + f"""
SELECT user_id, {_STATS_COLS},
       CAST(coalesce(sum(amount) FILTER (WHERE direction = 'IN'), 0) AS DOUBLE) AS total_in,
       CAST(coalesce(sum(amount) FILTER (WHERE direction = 'OUT'), 0) AS DOUBLE) AS total_out,
       CAST(coalesce(sum(amount), 0) AS DOUBLE) AS total_amount,
       CAST(coalesce(sum(amount) FILTER (WHERE direction = 'IN'), 0)
            - coalesce(sum(amount) FILTER (WHERE direction = 'OUT'), 0) AS DOUBLE) AS net_amount
FROM parts GROUP BY user_id""")
def q_stats_summary(spark, sf_dir):
    return history.stats_summary(history.in_closed_range(Frames(spark, sf_dir).tx_parts))


@register("stats_summary_admin", f"""
SELECT {_STATS_COLS}, CAST(0 AS DOUBLE) AS total_in, CAST(0 AS DOUBLE) AS total_out,
       CAST(coalesce(sum(amount), 0) AS DOUBLE) AS total_amount, CAST(0 AS DOUBLE) AS net_amount
FROM tx""")
def q_stats_summary_admin(spark, sf_dir):
    return history.stats_summary(history.in_closed_range(Frames(spark, sf_dir).tx), key=None)


@register("stats_points", _PARTS + """
SELECT user_id, date_trunc('month', created_at) AS period_start, strftime(created_at, '%m/%Y') AS label,
       CAST(count(*) AS BIGINT) AS total_transactions,
       CAST(coalesce(sum(amount) FILTER (WHERE direction = 'IN'), 0) AS DOUBLE) AS total_in,
       CAST(coalesce(sum(amount) FILTER (WHERE direction = 'OUT'), 0) AS DOUBLE) AS total_out,
       CAST(sum(amount) AS DOUBLE) AS total_amount
FROM parts GROUP BY ALL""")
def q_stats_points(spark, sf_dir):
    p = history.stats_points(history.in_closed_range(Frames(spark, sf_dir).tx_parts), "month")
    return p.withColumn("period_start", F.col("period_start").cast("timestamp_ntz"))


@register("status_breakdown", """
SELECT coalesce(nullif(upper(trim(status)), ''), 'UNKNOWN') AS status, CAST(count(*) AS BIGINT) AS n
FROM tx GROUP BY 1""")
def q_status_breakdown(spark, sf_dir):
    return history.status_breakdown(Frames(spark, sf_dir).tx)


# ---------------------------------------------------------------- monthly statements

@register("monthly_summary", _PARTS + """
SELECT user_id, '1997-05' AS month,
       CAST(coalesce(sum(amount) FILTER (WHERE side = 'IN'), 0) AS DOUBLE) AS total_received,
       CAST(coalesce(sum(amount) FILTER (WHERE side = 'OUT'), 0) AS DOUBLE) AS total_sent,
       CAST(coalesce(sum(amount) FILTER (WHERE side = 'IN'), 0) - coalesce(sum(amount) FILTER (WHERE side = 'OUT'), 0)
            AS DOUBLE) AS profit
FROM sides WHERE created_at BETWEEN TIMESTAMP '1997-05-01 00:00:00' AND TIMESTAMP '1997-05-31 23:59:59'
GROUP BY user_id""")
def q_monthly_summary(spark, sf_dir):
    return history.monthly_summary(Frames(spark, sf_dir).tx_sides, STATEMENT_MONTH)


@register("monthly_range", _PARTS + f"""
SELECT user_id, strftime(created_at, '%Y-%m') AS month,
       CAST(coalesce(sum(amount) FILTER (WHERE side = 'IN'), 0) AS DOUBLE) AS total_received,
       CAST(coalesce(sum(amount) FILTER (WHERE side = 'OUT'), 0) AS DOUBLE) AS total_sent,
       CAST(coalesce(sum(amount) FILTER (WHERE side = 'IN'), 0) - coalesce(sum(amount) FILTER (WHERE side = 'OUT'), 0)
            AS DOUBLE) AS profit
FROM sides WHERE {_HIST_RANGE} GROUP BY ALL""")
def q_monthly_range(spark, sf_dir):
    return history.monthly_range(Frames(spark, sf_dir).tx_sides, HIST_START, HIST_END)


# ---------------------------------------------------------------- recipients (intraday fact)

_RECIP = """
, rt AS (
  SELECT owner_user_id AS user_id, trim(CAST(counterparty_account_id AS VARCHAR)) AS account_number,
         count(*) AS transfer_count, sum(amount) AS total_amount
  FROM fact
  WHERE upper(trim(direction)) = 'OUT' AND coalesce(nullif(upper(trim(status)), ''), 'UNKNOWN') IN ('SUCCESS', 'COMPLETED')
    AND trim(CAST(counterparty_account_id AS VARCHAR)) <> '' AND created_at IS NOT NULL AND amount IS NOT NULL
  GROUP BY 1, 2),
named AS (
  SELECT rt.*, coalesce(nullif(trim(u.full_name), ''), 'Không rõ người nhận') AS full_name
  FROM rt LEFT JOIN accounts a ON a.account_number = rt.account_number LEFT JOIN users u ON u.user_id = a.user_id)
"""


def _recip(spark, sf_dir):
    return recipients.recipient_totals(Frames(spark, sf_dir).fact)


@register("recipient_totals", _RECIP + """
SELECT user_id, account_number, CAST(transfer_count AS BIGINT) AS transfer_count,
       CAST(total_amount AS DOUBLE) AS total_amount FROM rt""")
def q_recipient_totals(spark, sf_dir):
    return _recip(spark, sf_dir).select("user_id", "account_number", _b("transfer_count"), _d("total_amount"))


@register("enrich_recipient_name", _RECIP + """
SELECT user_id, account_number, full_name, CAST(transfer_count AS BIGINT) AS transfer_count,
       CAST(total_amount AS DOUBLE) AS total_amount FROM named""")
def q_enrich_recipient_name(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    named = recipients.enrich_recipient_name(_recip(spark, sf_dir), fr.accounts, fr.users)
    return named.select("user_id", "account_number", "full_name", _b("transfer_count"), _d("total_amount"))


@register("top_recipients", _RECIP + """
SELECT user_id, CAST(rank AS BIGINT) AS rank, full_name, account_number, CAST(transfer_count AS BIGINT) AS transfer_count,
       CAST(total_amount AS DOUBLE) AS total_amount
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY transfer_count DESC, total_amount DESC,
                                   lower(full_name), account_number) AS rank FROM named)
WHERE rank <= 5""")
def q_top_recipients(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    candidates = recipients.recipient_candidates(_recip(spark, sf_dir), k=5)
    return recipients.top_recipients(recipients.enrich_recipient_name(candidates, fr.accounts, fr.users), k=5)


# ---------------------------------------------------------------- account totals (monthly files)

def _monthly_files(spark, sf_dir):
    """All months as text files (header lines, short and bad lines among them),
    written once per version of the tables."""
    def write():
        tx = Frames(spark, sf_dir).tx
        month = F.date_format("created_at", "yyyy-MM")
        line = F.concat_ws(",", "transaction_id", "from_id", F.col("to_id").cast("string"), F.col("amount").cast("string"),
                           "status", F.col("created_at").cast("string"))
        odd = F.when(F.col("transaction_id") % 7 == 0, F.array(F.lit("id,from_account,to_account,amount,status,date"),
                                                               F.concat(F.lit("  "), line), F.lit("1,2,3"),
                                                               F.lit("9,8,7,not a number,SUCCESS,x"), F.lit("")))
        path = scratch_path(spark, "monthly")
        (tx.select(month.alias("month"), F.explode(F.coalesce(odd, F.array(line))).alias("value"))
         .hint("rebalance", "month").write.partitionBy("month").text(path))
        return path
    return stores.once(spark, "monthly", [f"{sf_dir}/{t}.parquet" for t in ("orders", "customer")], write)


def _monthly_rows(spark, sf_dir, months=None):
    """The months' rows read from their text files; the month predicate prunes the folders."""
    rows = fact_store.scan_monthly_csv(spark, _monthly_files(spark, sf_dir))
    if months:
        rows = rows.where(F.col("month").between(*months))
    return rows.select("month", F.col("from_account").cast("bigint"), "amount")


@register("total_by_account", """
SELECT strftime(created_at, '%Y-%m') AS month, from_id AS from_account, CAST(sum(amount) AS DOUBLE) AS total_amount
FROM tx WHERE amount IS NOT NULL GROUP BY 1, 2""")
def q_total_by_account(spark, sf_dir):
    return recipients.total_by_account(_monthly_rows(spark, sf_dir)).select("month", "from_account",
                                                                            _d("total_amount"))


@register("top_accounts", """
SELECT from_id AS from_account, CAST(sum(amount) AS DOUBLE) AS total_amount
FROM tx WHERE strftime(created_at, '%Y-%m') BETWEEN '1997-01' AND '1997-12' AND amount IS NOT NULL
GROUP BY 1 ORDER BY sum(amount) DESC, from_account LIMIT 10""")
def q_top_accounts(spark, sf_dir):
    totals = recipients.total_by_account(_monthly_rows(spark, sf_dir, ("1997-01", "1997-12")))
    return recipients.top_accounts(totals, "1997-01", "1997-12", k=10)
