"""Registered ledger, lookup, validation and integrity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from remitlens.operators import ledger, lookups
from remitlens.plans.model_frames import Frames
from remitlens.plans.registry import register

# ---------------------------------------------------------------- settlement

# Oracle: an ordered fold per sender as a recursive CTE (independent of the
# Spark plan, which splits safe senders from tight ones).
# Its input is the PENDING transfers with every awkward case among them: missing
# and negative amounts, unknown senders and receivers, transfers to oneself.
_SETTLE = """
, sx AS (
  SELECT transaction_id, CASE WHEN transaction_id % 73 = 0 THEN -transaction_id ELSE from_id END AS from_id,
         CASE WHEN transaction_id % 41 = 0 THEN -7 WHEN transaction_id % 43 = 0 THEN from_id ELSE to_id END AS to_id,
         CASE WHEN transaction_id % 37 = 0 THEN NULL WHEN transaction_id % 31 = 0 THEN -amount ELSE amount END AS amount,
         created_at
  FROM etx WHERE status = 'PENDING'),
pend AS (
  SELECT s.*, row_number() OVER (PARTITION BY from_id ORDER BY created_at, transaction_id) AS rn,
         coalesce(amount > 0, false) AS valid,
         EXISTS (SELECT 1 FROM accounts r WHERE r.account_id = s.to_id) AS to_known
  FROM sx s),
fold AS (
  SELECT p.from_id, p.rn, p.transaction_id, p.valid AND a.balance >= p.amount AS accepted,
         CASE WHEN p.valid AND a.balance >= p.amount AND p.to_known THEN a.balance - p.amount ELSE a.balance END AS bal
  FROM pend p JOIN accounts a ON a.account_id = p.from_id WHERE p.rn = 1
  UNION ALL
  SELECT p.from_id, p.rn, p.transaction_id, p.valid AND f.bal >= p.amount,
         CASE WHEN p.valid AND f.bal >= p.amount AND p.to_known THEN f.bal - p.amount ELSE f.bal END
  FROM fold f JOIN pend p ON p.from_id = f.from_id AND p.rn = f.rn + 1),
settled AS (
  SELECT p.transaction_id, p.from_id, p.to_id, p.amount, p.created_at,
         CASE WHEN coalesce(f.accepted, false) AND p.to_known THEN 'SUCCESS' ELSE 'FAILED' END AS status,
         CASE WHEN NOT p.valid THEN 'INVALID_AMOUNT'
              WHEN NOT coalesce(f.accepted, false) THEN 'INSUFFICIENT_BALANCE'
              WHEN NOT p.to_known THEN 'RECEIVER_NOT_FOUND' END AS reason
  FROM pend p LEFT JOIN fold f ON f.transaction_id = p.transaction_id),
moves AS (
  SELECT transaction_id, created_at, from_id AS account_id, 0 AS side, -amount AS delta FROM settled
  WHERE status = 'SUCCESS'
  UNION ALL
  SELECT transaction_id, created_at, to_id, 1, amount FROM settled WHERE status = 'SUCCESS')
"""


def settle_input(etx):
    """PENDING transfers with missing and negative amounts, unknown parties and
    transfers to oneself among them (the same rule as ``sx`` in the SQL)."""
    at = lambda n: F.col("transaction_id") % n == 0
    return etx.where(F.col("status") == "PENDING").select(
        "transaction_id", F.when(at(73), -F.col("transaction_id")).otherwise(F.col("from_id")).alias("from_id"),
        F.when(at(41), F.lit(-7)).when(at(43), F.col("from_id")).otherwise(F.col("to_id")).alias("to_id"),
        F.when(at(37), F.lit(None)).when(at(31), -F.col("amount")).otherwise(F.col("amount")).alias("amount"),
        "status", "created_at")


def _settled(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    return ledger.settle_batch(settle_input(fr.etx), fr.accounts)


@register("settle_batch", recursive=True, oracle=_SETTLE + """
SELECT transaction_id, from_id, to_id, CAST(amount AS DOUBLE) AS amount, created_at, status, reason FROM settled""")
def q_settle_batch(spark, sf_dir):
    s = _settled(spark, sf_dir)
    return s.select("transaction_id", "from_id", "to_id", F.col("amount").cast("double").alias("amount"),
                    "created_at", "status", "reason")


@register("ledger_balance", recursive=True, oracle=_SETTLE + """
SELECT a.account_id, CAST(a.balance AS DOUBLE) AS opening,
       CAST(a.balance + coalesce(m.net, 0) AS DOUBLE) AS balance
FROM accounts a LEFT JOIN (SELECT account_id, sum(delta) AS net FROM moves GROUP BY account_id) m
  ON m.account_id = a.account_id""")
def q_ledger_balance(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    b = ledger.ledger_balance(fr.accounts, ledger.ledger_movements(_settled(spark, sf_dir)))
    return b.select("account_id", F.col("opening").cast("double").alias("opening"),
                    F.col("balance").cast("double").alias("balance"))


@register("running_balance", recursive=True, oracle=_SETTLE + """
SELECT m.account_id, m.transaction_id, m.created_at, m.side, CAST(m.delta AS DOUBLE) AS delta,
       CAST(a.balance + sum(m.delta) OVER (PARTITION BY m.account_id ORDER BY m.created_at, m.transaction_id, m.side
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS balance_after
FROM moves m JOIN accounts a ON a.account_id = m.account_id""")
def q_running_balance(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    r = ledger.running_balance(fr.accounts, ledger.ledger_movements(_settled(spark, sf_dir)))
    return r.select("account_id", "transaction_id", "created_at", "side", F.col("delta").cast("double").alias("delta"),
                    F.col("balance_after").cast("double").alias("balance_after"))


@register("latest_status", recursive=True, oracle=_SETTLE + "SELECT transaction_id, status, created_at AS updated_at FROM settled")
def q_latest_status(spark, sf_dir):
    return ledger.latest_status(ledger.status_events(_settled(spark, sf_dir)))


# ---------------------------------------------------------------- balances / validation

@register("balance_lookup", """
SELECT r.from_id AS account_id, a.account_number, CAST(a.balance AS DOUBLE) AS balance, a.status
FROM (SELECT DISTINCT from_id FROM tx) r LEFT JOIN accounts a ON a.account_id = r.from_id""")
def q_balance_lookup(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    req = fr.tx.select(F.col("from_id").alias("account_id")).distinct()
    b = lookups.balance_lookup(req, fr.accounts)
    return b.select("account_id", "account_number", F.col("balance").cast("double").alias("balance"), "status")


@register("balance_check", """
SELECT t.transaction_id, t.from_id, CAST(t.amount AS DOUBLE) AS amount,
       CASE WHEN a.status IS NULL THEN 'ACCOUNT_NOT_FOUND' WHEN a.status <> 'ACTIVE' THEN 'ACCOUNT_NOT_ACTIVE'
            WHEN a.balance < t.amount THEN 'INSUFFICIENT_BALANCE' END AS reason,
       NOT (a.status IS NULL OR a.status <> 'ACTIVE' OR a.balance < t.amount) AS ok
FROM etx t LEFT JOIN accounts a ON a.account_id = t.from_id""")
def q_balance_check(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    c = lookups.balance_check(fr.etx, fr.accounts)
    return c.select("transaction_id", "from_id", F.col("amount").cast("double").alias("amount"), "reason", "ok")


@register("transfer_validate", _SETTLE.split("pend AS (")[0].rstrip().rstrip(",") + """
SELECT t.transaction_id, t.from_id, t.to_id, CAST(t.amount AS DOUBLE) AS amount,
       CASE WHEN t.from_id IS NULL OR t.to_id IS NULL OR t.amount IS NULL THEN 'MISSING_FIELD'
            WHEN t.from_id = t.to_id THEN 'SAME_ACCOUNT'
            WHEN t.amount <= 0 THEN 'INVALID_AMOUNT'
            WHEN r.account_id IS NULL THEN 'RECEIVER_NOT_FOUND'
            WHEN s.status IS NULL OR s.status <> 'ACTIVE' THEN 'NO_ACTIVE_ACCOUNT'
            WHEN s.balance < t.amount THEN 'INSUFFICIENT_BALANCE' END AS reject_reason
FROM sx t LEFT JOIN accounts s ON s.account_id = t.from_id LEFT JOIN accounts r ON r.account_id = t.to_id""")
def q_transfer_validate(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    v = lookups.transfer_validate(settle_input(fr.etx), fr.accounts)
    return v.select("transaction_id", "from_id", "to_id", F.col("amount").cast("double").alias("amount"),
                    "reject_reason")


@register("accounts_by_user_status", """
, several AS (  -- three accounts a user, opened out of order, some on the same day
  SELECT account_id, account_id // 3 AS user_id, status,
         TIMESTAMP '2020-01-01' + to_days(CAST((account_id * 37) % 10 AS INTEGER)) AS created_at FROM accounts)
SELECT user_id, arg_min(account_id, (created_at, account_id)) AS account_id, CAST(count(*) AS BIGINT) AS n_accounts
FROM several WHERE status = 'ACTIVE' GROUP BY user_id""")
def q_accounts_by_user_status(spark, sf_dir):
    key = F.col("account_id")
    opened = F.lit("2020-01-01").cast("timestamp_ntz") + F.make_dt_interval(((key * 37) % 10).cast("int"))
    several = Frames(spark, sf_dir).accounts.select(
        "account_id", F.floor(key / 3).alias("user_id"), "status", opened.alias("created_at"))
    return lookups.accounts_by_user_status(several, "ACTIVE")


@register("account_lookup", """
SELECT n.account_number, a.user_id, a.status, u.full_name
FROM (SELECT DISTINCT counterparty_account_id AS account_number FROM fact) n
LEFT JOIN accounts a ON a.account_number = n.account_number LEFT JOIN users u ON u.user_id = a.user_id""")
def q_account_lookup(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    nums = fr.fact.select(F.col("counterparty_account_id").alias("account_number")).distinct()
    return lookups.account_lookup(nums, fr.accounts, fr.users).select("account_number", "user_id", "status",
                                                                      "full_name")


@register("exists_semi", """
SELECT e.transaction_id, e.from_id, e.to_id FROM etx e
WHERE EXISTS (SELECT 1 FROM tx t WHERE t.transaction_id = e.transaction_id)""")
def q_exists_semi(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    return lookups.exists_semi(fr.etx, fr.tx, "transaction_id").select("transaction_id", "from_id", "to_id")


@register("integrity_anti", """
SELECT 'tx.from_id->accounts' AS rule, CAST(transaction_id AS VARCHAR) AS key_value FROM tx
WHERE from_id IS NOT NULL AND from_id NOT IN (SELECT account_id FROM accounts WHERE account_id % 97 <> 0)
UNION ALL
SELECT 'tx.to_id->accounts', CAST(transaction_id AS VARCHAR) FROM tx
WHERE to_id IS NOT NULL AND to_id NOT IN (SELECT account_id FROM accounts WHERE account_id % 97 <> 0)
UNION ALL
SELECT 'lineitem.l_orderkey->orders', CAST(l_orderkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR)
FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL
SELECT 'lineitem.l_partkey->part', CAST(l_orderkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR)
FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 53 <> 0)""")
def q_integrity_anti(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    acc = fr.accounts.where(F.col("account_id") % 97 != 0)  # some parents are gone
    parts = [
        lookups.integrity_anti(fr.tx.select("transaction_id", "from_id"), acc.withColumnRenamed("account_id", "a"),
                               "from_id", "a", "tx.from_id->accounts")
        .select("rule", F.col("transaction_id").cast("string").alias("key_value")),
        lookups.integrity_anti(fr.tx.select("transaction_id", "to_id"), acc.withColumnRenamed("account_id", "a"),
                               "to_id", "a", "tx.to_id->accounts")
        .select("rule", F.col("transaction_id").cast("string").alias("key_value")),
    ]
    li = fr.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    line_key = F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    parts.append(lookups.integrity_anti(li, fr.table("orders"), "l_orderkey", "o_orderkey",
                                        "lineitem.l_orderkey->orders").select("rule", line_key.alias("key_value")))
    parts.append(lookups.integrity_anti(li, fr.table("part").where("p_partkey % 53 <> 0"), "l_partkey", "p_partkey",
                                        "lineitem.l_partkey->part").select("rule", line_key.alias("key_value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("count_by_key", """
SELECT from_id, CAST(count(*) AS BIGINT) AS n FROM tx GROUP BY from_id""")
def q_count_by_key(spark, sf_dir):
    return lookups.count_by_key(Frames(spark, sf_dir).tx, "from_id")


@register("account_primary", """
SELECT user_id, account_id AS primary_account_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC NULLS LAST, account_id) AS rn FROM (
    SELECT account_id // 4 AS user_id, account_id, CASE WHEN account_id % 5 > 0 THEN
           TIMESTAMP '2024-01-01' + to_days(CAST(account_id % 3 AS INTEGER)) END AS created_at FROM accounts))
WHERE rn = 1""")
def q_account_primary(spark, sf_dir):
    """Four accounts per user, opened on different days, some without a time."""
    day = F.make_interval(days=(F.col("account_id") % 3).cast("int"))
    acc = Frames(spark, sf_dir).accounts.select(
        "account_id", F.floor(F.col("account_id") / 4).alias("user_id"),
        F.when(F.col("account_id") % 5 > 0, F.lit("2024-01-01").cast("timestamp_ntz") + day).alias("created_at"))
    return lookups.account_primary(acc)


_SAVED = """
, saved AS (
  SELECT t.from_id AS user_id, t.to_id AS target_account_id, max(t.created_at) AS updated_at
  FROM tx t GROUP BY 1, 2)
"""


@register("recent_receivers", _SAVED + """
SELECT user_id, target_account_id, updated_at, CAST(position AS BIGINT) AS position FROM (
  SELECT s.*, row_number() OVER (PARTITION BY s.user_id ORDER BY s.updated_at DESC, s.target_account_id DESC) - 1
           AS position
  FROM saved s LEFT JOIN accounts a ON a.account_id = s.target_account_id
  WHERE a.user_id IS NULL OR a.user_id <> s.user_id)
WHERE position < 6""")
def q_recent_receivers(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    saved = fr.tx.select(F.col("from_id").alias("user_id"), F.col("to_id").alias("target_account_id"),
                         F.col("created_at").alias("updated_at"))
    return lookups.recent_receivers(saved, fr.accounts)


# Registration rows derived from customers (a batch) and suppliers (users that exist already). Contacts are shared inside
# the batch and with the users, also by rows that are rejected for another contact; every field is bad in some rows.
_REG = """
, reg AS (
  SELECT c_custkey AS seq, CASE WHEN c_custkey % 29 = 0 THEN ' ' ELSE c_name END AS full_name,
         CASE WHEN c_custkey % 31 = 0 THEN c_custkey || '-no-mail'
              WHEN c_custkey % 25 = 7 THEN 'supplier.' || lpad(CAST(c_custkey // 25 AS VARCHAR), 9, '0') || '@mail.vn'
              ELSE 'customer.' || CAST(c_custkey - CASE WHEN c_custkey % 10 = 4 THEN 3 ELSE 0 END AS VARCHAR) || '@mail.vn'
         END AS email,
         CASE WHEN c_custkey % 17 = 3 THEN '1' || lpad(CAST(c_custkey AS VARCHAR), 9, '0')
              WHEN c_custkey % 19 <> 8 THEN '09' || lpad(CAST(c_custkey // 3 AS VARCHAR), 8, '1') END AS phone,
         CASE WHEN c_custkey % 23 = 0 THEN CAST(c_custkey AS VARCHAR)
              ELSE lpad(CAST(c_custkey - CASE WHEN c_custkey % 9 = 5 THEN 2 ELSE 0 END AS VARCHAR), 12, '0') END AS identity_card,
         CASE WHEN c_custkey % 43 = 0 THEN '12ab' ELSE CAST(100000000000 + c_custkey AS VARCHAR) END AS account_number,
         CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE n_name END AS province,
         CASE WHEN c_custkey % 41 = 0 THEN '' ELSE c_mktsegment END AS district
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
old AS (
  SELECT s_suppkey AS user_id, 'supplier.' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || '@mail.vn' AS email,
         '09' || lpad(CAST(s_suppkey * 5 AS VARCHAR), 8, '1') AS phone,
         lpad(CAST(s_suppkey * 7 AS VARCHAR), 12, '0') AS identity_card
  FROM supplier)
"""


def _registrations(fr):
    c, n = fr.table("customer"), fr.table("nation")
    key = F.col("c_custkey")

    def digits(value, width, fill="0"):
        return F.lpad(value.cast("string"), width, fill)

    def less(every, rest, by):
        return key - F.when(key % every == rest, by).otherwise(0)

    third, part = F.floor(key / 3), F.floor(key / 25)
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        key.alias("seq"), F.when(key % 29 == 0, F.lit(" ")).otherwise(F.col("c_name")).alias("full_name"),
        F.when(key % 31 == 0, F.concat(key.cast("string"), F.lit("-no-mail")))
        .when(key % 25 == 7, F.concat(F.lit("supplier."), digits(part, 9), F.lit("@mail.vn")))
        .otherwise(F.concat(F.lit("customer."), less(10, 4, 3).cast("string"), F.lit("@mail.vn"))).alias("email"),
        F.when(key % 17 == 3, F.concat(F.lit("1"), digits(key, 9)))
        .when(key % 19 != 8, F.concat(F.lit("09"), digits(third, 8, "1"))).alias("phone"),
        F.when(key % 23 == 0, key.cast("string")).otherwise(digits(less(9, 5, 2), 12)).alias("identity_card"),
        F.when(key % 43 == 0, F.lit("12ab")).otherwise((F.lit(100000000000) + key).cast("string")).alias("account_number"),
        F.when(key % 37 != 0, F.col("n_name")).alias("province"),
        F.when(key % 41 == 0, F.lit("")).otherwise(F.col("c_mktsegment")).alias("district"))


def _existing(fr):
    key = F.col("s_suppkey")
    return fr.table("supplier").select(
        key.alias("user_id"), F.concat(F.lit("supplier."), F.lpad(key.cast("string"), 9, "0"), F.lit("@mail.vn")).alias("email"),
        F.concat(F.lit("09"), F.lpad((key * 5).cast("string"), 8, "1")).alias("phone"),
        F.lpad((key * 7).cast("string"), 12, "0").alias("identity_card"))


# Rows of ``asked`` (seq and three contacts) taken one after the other; an accepted row's contacts join the lists.
_IN_TURN = """
, turn AS (SELECT *, row_number() OVER (ORDER BY seq) AS rn FROM asked),
walk AS (
  SELECT CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS seq, CAST([] AS VARCHAR[]) AS violations,
         CAST([] AS VARCHAR[]) AS es, CAST([] AS VARCHAR[]) AS ps, CAST([] AS VARCHAR[]) AS cs
  UNION ALL
  SELECT rn, seq, v, CASE WHEN len(v) = 0 THEN list_append(es, email) ELSE es END,
         CASE WHEN len(v) = 0 THEN list_append(ps, phone) ELSE ps END,
         CASE WHEN len(v) = 0 THEN list_append(cs, identity_card) ELSE cs END
  FROM (
    SELECT t.*, w.es, w.ps, w.cs, list_filter([
        CASE WHEN t.email IN (SELECT email FROM old) THEN 'email_exists'
             WHEN list_contains(w.es, t.email) THEN 'email_duplicate_in_batch' END,
        CASE WHEN t.phone IN (SELECT phone FROM old) THEN 'phone_exists'
             WHEN list_contains(w.ps, t.phone) THEN 'phone_duplicate_in_batch' END,
        CASE WHEN t.identity_card IN (SELECT identity_card FROM old) THEN 'identity_card_exists'
             WHEN list_contains(w.cs, t.identity_card) THEN 'identity_card_duplicate_in_batch' END],
        lambda x: x IS NOT NULL) AS v
    FROM walk w JOIN turn t ON t.rn = w.rn + 1))
SELECT seq, violations FROM walk WHERE len(violations) > 0"""


@register("row_quality", _REG + r"""
SELECT seq, list_filter([
    CASE WHEN NOT coalesce(regexp_matches(account_number, '^\d{6,20}$'), false) THEN 'account_number' END,
    CASE WHEN NOT coalesce(regexp_matches(identity_card, '^\d{12}$'), false) THEN 'identity_card' END,
    CASE WHEN NOT coalesce(regexp_matches(phone, '^(0|\+84)(\s|\.)?((3[2-9])|(5[689])|(7[06-9])|(8[1-689])|(9[0-46-9]))(\d)(\s|\.)?(\d{3})(\s|\.)?(\d{3})$'), false) THEN 'phone' END,
    CASE WHEN NOT coalesce(regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$'), false) THEN 'email' END,
    CASE WHEN full_name IS NULL OR trim(full_name) = '' OR length(trim(full_name)) < 2 THEN 'full_name' END,
    CASE WHEN province IS NULL OR trim(province) = '' THEN 'province' END,
    CASE WHEN district IS NULL OR trim(district) = '' THEN 'district' END], lambda x: x IS NOT NULL) AS violations
FROM reg""")
def q_row_quality(spark, sf_dir):
    return lookups.row_quality(_registrations(Frames(spark, sf_dir))).select("seq", "violations")


@register("dup_contacts", recursive=True, oracle=_REG
          + ", asked AS (SELECT seq, email, phone, identity_card FROM reg)" + _IN_TURN)
def q_dup_contacts(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    return lookups.dup_contacts(_registrations(fr), _existing(fr)).select("seq", "violations")


@register("profile_conflicts", recursive=True, oracle=_REG + """
, upd AS (  -- every registration row as an update of a supplier's profile; some keep a contact, with blanks around it
  SELECT r.seq, o.email AS old_email, o.phone AS old_phone, o.identity_card AS old_card,
         CASE WHEN r.seq % 4 = 0 THEN ' ' || o.email || ' ' ELSE r.email END AS email,
         CASE WHEN r.seq % 4 = 1 THEN o.phone ELSE r.phone END AS phone,
         CASE WHEN r.seq % 4 = 2 THEN o.identity_card ELSE r.identity_card END AS identity_card
  FROM reg r JOIN old o ON o.user_id = (SELECT min(user_id) FROM old) + r.seq % (SELECT count(*) FROM old)),
asked AS (
  SELECT seq, CASE WHEN trim(email) IS DISTINCT FROM trim(old_email) THEN email END AS email,
         CASE WHEN trim(phone) IS DISTINCT FROM trim(old_phone) THEN phone END AS phone,
         CASE WHEN trim(identity_card) IS DISTINCT FROM trim(old_card) THEN identity_card END AS identity_card FROM upd)
""" + _IN_TURN)
def q_profile_conflicts(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    old = _existing(fr)
    least, n = old.agg(F.min("user_id").alias("x")).scalar(), old.agg(F.count(F.lit(1)).alias("n")).scalar()
    mine = old.select("user_id", *[F.col(k).alias(f"own_{k}") for k in ("email", "phone", "identity_card")])
    rows = _registrations(fr).withColumn("user_id", least + F.col("seq") % n).join(mine, "user_id")
    updates = rows.select(
        "seq", "user_id",
        F.when(F.col("seq") % 4 == 0, F.concat(F.lit(" "), F.col("own_email"), F.lit(" "))).otherwise(F.col("email")).alias("email"),
        F.when(F.col("seq") % 4 == 1, F.col("own_phone")).otherwise(F.col("phone")).alias("phone"),
        F.when(F.col("seq") % 4 == 2, F.col("own_identity_card")).otherwise(F.col("identity_card")).alias("identity_card"))
    return lookups.profile_conflicts(updates, old).select("seq", "violations")


@register("check_constraints", """
SELECT 'account_status' AS rule, CAST(account_id AS VARCHAR) AS key_value FROM accounts
WHERE account_id % 11 = 0 OR account_id % 13 = 0
UNION ALL
SELECT 'user_role', CAST(user_id AS VARCHAR) FROM users WHERE user_id % 3 = 1
UNION ALL
SELECT 'notification_type', CAST(transaction_id AS VARCHAR) FROM tx WHERE transaction_id % 5 = 0
UNION ALL
SELECT 'user_province_missing', CAST(user_id AS VARCHAR) FROM users WHERE province IS NULL
UNION ALL
SELECT 'transfer_pending', CAST(transaction_id AS VARCHAR) FROM tx WHERE status = 'PENDING'""")
def q_check_constraints(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    status = F.when(F.col("account_id") % 11 == 0, F.lit("CLOSED")).when(F.col("account_id") % 13 != 0, F.col("status"))
    role = F.when(F.col("user_id") % 3 == 0, "CUSTOMER").when(F.col("user_id") % 3 == 1, "USER").otherwise("ADMIN")
    kind = F.when(F.col("transaction_id") % 5 == 0, "NEWS").otherwise("ALERT")
    return lookups.check_constraints(fr.accounts.withColumn("status", status), fr.users.withColumn("role", role),
                                     fr.tx.select("transaction_id", kind.alias("type")), transfers=fr.tx)


@register("rekey_backfill", """
SELECT a.account_id, sha256('remitlens-user:' || CAST(a.user_id AS VARCHAR)) AS user_id, a.account_number
FROM accounts a""")
def q_rekey_backfill(spark, sf_dir):
    fr = Frames(spark, sf_dir)
    _, children = lookups.rekey_backfill(fr.users, fr.accounts.select("account_id", "user_id", "account_number"))
    return children


@register("rekey_users", """
SELECT sha256('remitlens-user:' || CAST(user_id AS VARCHAR)) AS user_id, user_id AS legacy_id, full_name,
       coalesce(province, 'Unknown') AS province, CASE WHEN user_id % 7 = 0 THEN 'Unknown' ELSE district END AS district,
       CASE WHEN user_id % 4 = 3 THEN 'ADMIN' ELSE 'CUSTOMER' END AS role
FROM users""")
def q_rekey_users(spark, sf_dir):
    """The re-keyed users: missing, 'User' and 'user' roles become CUSTOMER, blank places 'Unknown'."""
    fr = Frames(spark, sf_dir)
    role = F.get(F.array(F.lit(None), F.lit("User"), F.lit("user"), F.lit("ADMIN")), (F.col("user_id") % 4).cast("int"))
    district = F.when(F.col("user_id") % 7 == 0, F.lit("  ")).otherwise(F.col("district"))
    users, _ = lookups.rekey_backfill(fr.users.withColumns({"role": role, "district": district}), fr.accounts)
    return users


@register("random_sample", """
SELECT account_id, user_id, account_number, CAST(balance AS DOUBLE) AS balance, status FROM accounts
ORDER BY sha256('7:' || account_id) LIMIT 2""")
def q_random_sample(spark, sf_dir):
    """Two random accounts."""
    picked = lookups.random_sample(Frames(spark, sf_dir).accounts, 2, seed=7)
    return picked.select("account_id", "user_id", "account_number", F.col("balance").cast("double").alias("balance"), "status")
