"""Lookups, validation, integrity and per-key window operators over the
account/user/transfer tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.functions import scalars as S
from remitlens.session import materialize

# ---------------------------------------------------------------------------
# Fixed values of the validation rules.
ACCOUNT_NUMBER_PATTERN = r"^\d{6,20}$"
IDENTITY_CARD_PATTERN = r"^\d{12}$"
MOBILE_PATTERN = (r"^(0|\+84)(\s|\.)?((3[2-9])|(5[689])|(7[06-9])|(8[1-689])|(9[0-46-9]))(\d)(\s|\.)?"
                  r"(\d{3})(\s|\.)?(\d{3})$")
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
ACCOUNT_STATUSES = ["ACTIVE", "INACTIVE", "SUSPENDED"]
NOTIFICATION_TYPES = ["ALERT", "MARKETING", "TRANSACTION"]
ROLES = ["ADMIN", "CUSTOMER"]
DEFAULT_ROLE = "CUSTOMER"
MAX_SAVED_RECEIVERS = 6
# ---------------------------------------------------------------------------


def _present(flags: list[Column]) -> Column:
    """The non-null entries of ``flags`` in order (distinct names): a set
    difference with ``[null]``, which stays in generated code."""
    return F.array_except(F.array(*flags), F.array(F.lit(None).cast("string")))


def audit_query(audit: DataFrame, transaction_id=None, account=None, status=None) -> DataFrame:
    """Audit rows by transaction id, by account (from OR to), by status, or all —
    newest first (a distributed range-partitioned sort)."""
    rows = audit
    if transaction_id is not None:
        rows = rows.where(F.col("transaction_id") == transaction_id)
    if account is not None:
        rows = rows.where((F.col("from_account") == account) | (F.col("to_account") == account))
    if status is not None:
        rows = rows.where(F.col("status") == status)
    return rows.orderBy(F.desc("processed_at"), F.desc("transaction_id"))


def notification_query(notes: DataFrame, page: int = 0, size: int = 20, kind: str | None = None) -> DataFrame:
    """Page ``page`` of each user's notifications, newest first, optional type.
    ``row_number() < (page+1)*size`` → WindowGroupLimit (bounded per user per task).
    Every row carries the user's total_elements and total_pages."""
    rows = notes if kind is None else notes.where(F.col("type") == kind)
    w = Window.partitionBy("user_id").orderBy(F.desc("created_at"), F.desc("transaction_id"), "type")
    # Filter on the row number itself so Spark plans a WindowGroupLimit.
    ranked = rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= (page + 1) * size)
    totals = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("total_elements"))
    return (ranked.where(F.col("_rn") > page * size).join(totals, "user_id")
            .withColumn("total_pages", F.ceil(F.col("total_elements") / F.lit(size)).cast("bigint"))
            .withColumn("position", (F.col("_rn") - 1).cast("bigint")).drop("_rn"))


def accounts_by_user_status(accounts: DataFrame, status: str = "ACTIVE") -> DataFrame:
    """A user's accounts in a status; the transfer source is the earliest one
    (deterministic ``min_by`` instead of an arbitrary "first")."""
    order = _packed_order(F.col("created_at"), F.col("account_id"), 10**18, 1) \
        if "created_at" in accounts.columns else F.col("account_id")
    return (accounts.where(F.col("status") == status).groupBy("user_id")
            .agg(F.min_by("account_id", order).alias("account_id"),
                 F.count(F.lit(1)).cast("bigint").alias("n_accounts")))


def balance_lookup(requests: DataFrame, accounts: DataFrame, by: str = "account_id") -> DataFrame:
    """Balance of each requested account (by id or by account number)."""
    return requests.join(accounts.select(by, "account_number" if by != "account_number" else "account_id",
                                         "balance", "status"), by, "left")


def balance_check(transfers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Per transfer request: ``ok`` = sender account ACTIVE and balance ≥ amount,
    plus the reason when not."""
    a = accounts.select(F.col("account_id").alias("from_id"), F.col("balance").alias("from_balance"),
                        F.col("status").alias("from_status"))
    j = transfers.join(a, "from_id", "left")
    reason = (F.when(F.col("from_status").isNull(), F.lit("ACCOUNT_NOT_FOUND"))
              .when(F.col("from_status") != "ACTIVE", F.lit("ACCOUNT_NOT_ACTIVE"))
              .when(F.col("from_balance") < F.col("amount"), F.lit("INSUFFICIENT_BALANCE")))
    return j.withColumn("reason", reason).withColumn("ok", F.col("reason").isNull())


def transfer_validate(transfers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Reject reason per request: missing ids/amount, same account, amount ≤ 0,
    receiver unknown, no active sender account, insufficient balance."""
    s = accounts.select(F.col("account_id").alias("from_id"), F.col("balance").alias("from_balance"),
                        F.col("status").alias("from_status"))
    r = accounts.select(F.col("account_id").alias("to_id"), F.lit(True).alias("_to_known"))
    j = transfers.join(s, "from_id", "left").join(r, "to_id", "left")
    reason = (F.when(F.col("from_id").isNull() | F.col("to_id").isNull() | F.col("amount").isNull(),
                     F.lit("MISSING_FIELD"))
              .when(F.col("from_id") == F.col("to_id"), F.lit("SAME_ACCOUNT"))
              .when(F.col("amount") <= 0, F.lit("INVALID_AMOUNT"))
              .when(F.col("_to_known").isNull(), F.lit("RECEIVER_NOT_FOUND"))
              .when(F.col("from_status").isNull() | (F.col("from_status") != "ACTIVE"), F.lit("NO_ACTIVE_ACCOUNT"))
              .when(F.col("from_balance") < F.col("amount"), F.lit("INSUFFICIENT_BALANCE")))
    return j.withColumn("reject_reason", reason).drop("_to_known")


def account_lookup(numbers: DataFrame, accounts: DataFrame, users: DataFrame) -> DataFrame:
    """Account number → holder name and status (left join; unknown → nulls)."""
    holders = accounts.select("account_number", "user_id", "status").join(
        users.select("user_id", "full_name"), "user_id", "left")
    return numbers.join(holders, "account_number", "left")


def exists_semi(candidates: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Candidates whose ``key`` already exists (conflicts) — left-semi join."""
    return candidates.join(existing.select(key).where(F.col(key).isNotNull()), key, "left_semi")


def integrity_anti(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, rule: str) -> DataFrame:
    """Child rows whose foreign key has no parent (left-anti join), tagged with the rule.

    Duplicate parent keys do not change an anti join, so the parent side is
    not de-duplicated first (no extra aggregate over the parent table)."""
    p = parent.select(F.col(parent_key).alias(child_key))
    return (child.where(F.col(child_key).isNotNull()).join(p, child_key, "left_anti")
            .select(F.lit(rule).alias("rule"), F.col(child_key).cast("string").alias("key_value"), *child.columns))


def count_by_key(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).cast("bigint").alias(name))


def _packed_order(created_at: Column, account_id: Column, missing: int, direction: int) -> Column:
    """(created_at, account_id) as one decimal, which has a fixed-width
    aggregation buffer: microseconds in front, the id (ascending or, with
    ``direction`` -1, descending) behind; ``missing`` stands for no time."""
    micros = F.coalesce(F.unix_micros(created_at.cast("timestamp")), F.lit(missing)).cast("decimal(38,0)")
    return micros * F.lit(10**18).cast("decimal(19,0)") + (account_id * direction).cast("decimal(18,0)")


def account_primary(accounts: DataFrame) -> DataFrame:
    """Each user's newest account (no time last, ties to the smallest id):
    position 0 of the list newest first, as ``max_by`` over a fixed-width order
    (hash aggregate with a map-side step)."""
    order = _packed_order(F.col("created_at"), F.col("account_id"), -(10**18), -1)
    return accounts.groupBy("user_id").agg(F.max_by("account_id", order).alias("primary_account_id"))


def recent_receivers(saved: DataFrame, accounts: DataFrame, k: int = MAX_SAVED_RECEIVERS) -> DataFrame:
    """Upsert on (user, target) keeping the latest update, drop own accounts,
    keep the ``k`` most recently updated per user (WindowGroupLimit)."""
    latest = saved.groupBy("user_id", "target_account_id").agg(F.max("updated_at").alias("updated_at"))
    owners = accounts.select(F.col("account_id").alias("target_account_id"),
                             F.col("user_id").alias("target_user_id"))
    j = latest.join(owners, "target_account_id", "left").where(
        F.col("target_user_id").isNull() | (F.col("target_user_id") != F.col("user_id")))
    w = Window.partitionBy("user_id").orderBy(F.desc("updated_at"), F.desc("target_account_id"))
    return (j.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
            .select("user_id", "target_account_id", "updated_at", (F.col("_rn") - 1).cast("bigint").alias("position")))


def dup_contacts(batch: DataFrame, users: DataFrame, keys=("email", "phone", "identity_card"),
                 seq: str = "seq") -> DataFrame:
    """Registration rows rejected for a duplicate contact, with their violations:
    a user has the value (``<key>_exists``), or an earlier row of the batch that
    was accepted has it (``<key>_duplicate_in_batch``). A rejected row is not
    stored, so it claims no value. ``seq`` is the order and must be unique; null
    values are no duplicates.

    Rows that a user's value rejects go first. Then rounds to a fixed point: a
    row that comes first among the undecided rows for each of its values is
    accepted, and all other undecided holders of these values are rejected. What
    is left depends on decided rows only and goes into the next round. A round
    is one aggregate by value (a value that a third of the rows share collapses
    before the shuffle, and is decided in its first round) and one join back.
    """
    values = F.explode(F.array_compact(F.array(*[
        F.when(F.col(k).isNotNull(), F.struct(F.lit(i).alias("key"), F.col(k).cast("string").alias("value")))
        for i, k in enumerate(keys)])))

    def held(rows: DataFrame, *cols: str) -> DataFrame:
        return rows.select(*cols, values.alias("_h")).select(*cols, "_h.key", "_h.value")

    holders = held(batch, seq)
    taken = held(users).distinct()
    exists = materialize(holders.join(taken, ["key", "value"], "left_semi"))
    claims = [holders.sparkSession.createDataFrame([], holders.schema)]
    free = batch.select(seq).join(exists.select(seq), seq, "left_anti")
    open_ = materialize(holders.join(free, seq, "left_semi"))
    while not open_.isEmpty():
        first = open_.groupBy("key", "value").agg(F.min(seq).alias("_first"))
        turn = materialize(open_.join(first, ["key", "value"]))
        accepted = turn.groupBy(seq).agg(F.min((F.col(seq) == F.col("_first")).cast("int")).alias("_all")).where("_all = 1")
        claimed = materialize(open_.join(accepted.select(seq), seq, "left_semi"))
        claims.append(claimed)
        gone = open_.join(claimed.select("key", "value"), ["key", "value"], "left_semi").select(seq).distinct()
        open_ = materialize(open_.join(gone, seq, "left_anti"))
    claimed = claims[0]
    for more in claims[1:]:
        claimed = claimed.unionByName(more)
    late = holders.join(claimed.withColumnRenamed(seq, "_by"), ["key", "value"]).where(F.col("_by") < F.col(seq))
    # "exists" wins over "duplicate in batch" for the same key, as a user's value is looked up first
    flags = exists.select(seq, "key", F.lit(True).alias("_user")).unionByName(
        late.select(seq, "key", F.lit(False).alias("_user"))).groupBy(seq).agg(*[
            F.max(F.when(F.col("key") == i, F.col("_user"))).alias(f"_flag_{i}") for i in range(len(keys))])
    names = [F.when(F.col(f"_flag_{i}"), F.lit(f"{k}_exists")).when(~F.col(f"_flag_{i}"), F.lit(f"{k}_duplicate_in_batch"))
             for i, k in enumerate(keys)]
    return batch.join(flags.select(seq, _present(names).alias("violations")), seq)


def profile_conflicts(updates: DataFrame, users: DataFrame, keys=("email", "phone", "identity_card"),
                      key: str = "user_id", seq: str = "seq") -> DataFrame:
    """Profile updates rejected because another user has a contact, with their
    violations. A value that equals the user's present one (both trimmed) is no
    change and is not looked up. Updates are taken in the order of ``seq``: an
    accepted one claims its new values against later ones, a rejected one claims
    nothing, and a value given up is free from the next batch on."""
    old = users.select(F.col(key), *[F.col(k).alias(f"_old_{k}") for k in keys])
    new = updates.join(old, key, "left")
    changed = [F.when(F.trim(F.col(k)).eqNullSafe(F.trim(F.col(f"_old_{k}"))), F.lit(None)).otherwise(F.col(k)).alias(k)
               for k in keys]
    found = dup_contacts(new.select(seq, *changed), users, keys, seq)
    return updates.join(found.select(seq, "violations"), seq)


def row_quality(rows: DataFrame) -> DataFrame:
    """Violated field rules per row as an array; empty array = good row."""
    def rule(name: str, bad: Column) -> Column:
        return F.when(bad, F.lit(name))

    def blank(c):
        return F.col(c).isNull() | (F.trim(F.col(c)) == "")

    checks = [
        rule("account_number", ~F.coalesce(F.col("account_number").rlike(ACCOUNT_NUMBER_PATTERN), F.lit(False))),
        rule("identity_card", ~F.coalesce(F.col("identity_card").rlike(IDENTITY_CARD_PATTERN), F.lit(False))),
        rule("phone", ~F.coalesce(F.col("phone").rlike(MOBILE_PATTERN), F.lit(False))),
        rule("email", ~F.coalesce(F.col("email").rlike(EMAIL_PATTERN), F.lit(False))),
        rule("full_name", blank("full_name") | (F.length(F.trim(F.col("full_name"))) < 2)),
        rule("province", blank("province")),
        rule("district", blank("district")),
    ]
    return rows.withColumn("violations", _present(checks))


def check_constraints(accounts: DataFrame, users: DataFrame, notifications: DataFrame | None = None,
                      transfers: DataFrame | None = None) -> DataFrame:
    """Rows breaking allowed values (account status, role, notification type),
    PENDING transfers, and users without a province (IS NULL, not '= null')."""
    parts = [
        accounts.where(F.col("status").isNull() | ~F.col("status").isin(*ACCOUNT_STATUSES))
        .select(F.lit("account_status").alias("rule"), F.col("account_id").cast("string").alias("key_value")),
        users.where(F.col("province").isNull())
        .select(F.lit("user_province_missing").alias("rule"), F.col("user_id").cast("string").alias("key_value")),
    ]
    if "role" in users.columns:
        parts.append(users.where(~F.col("role").isin(*ROLES))
                     .select(F.lit("user_role").alias("rule"), F.col("user_id").cast("string").alias("key_value")))
    if notifications is not None:
        parts.append(notifications.where(~F.col("type").isin(*NOTIFICATION_TYPES))
                     .select(F.lit("notification_type").alias("rule"),
                             F.col("transaction_id").cast("string").alias("key_value")))
    if transfers is not None:
        parts.append(transfers.where(F.col("status") == "PENDING")
                     .select(F.lit("transfer_pending").alias("rule"),
                             F.col("transaction_id").cast("string").alias("key_value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rekey_backfill(users: DataFrame, children: DataFrame, old_key: str = "user_id", child_fk: str = "user_id",
                   default_role: str = DEFAULT_ROLE, namespace: str = "remitlens-user") -> tuple[DataFrame, DataFrame]:
    """New deterministic keys (sha2 of namespace + old key; stable across
    retries, unlike uuid()), children re-pointed by joining old → new key, blank
    province/district → 'Unknown', missing role and the old 'User' → default."""
    new_key = F.sha2(F.concat(F.lit(namespace + ":"), F.col(old_key).cast("string")), 256)
    mapping = users.select(F.col(old_key).alias("_old"), new_key.alias("_new"))
    role = F.when(F.col("role").isNull() | (F.lower("role") == "user"), F.lit(default_role)).otherwise(F.col("role")) \
        if "role" in users.columns else F.lit(default_role)
    new_users = users.select(
        new_key.alias("user_id"), F.col(old_key).alias("legacy_id"), "full_name",
        S.blank_to(F.col("province"), "Unknown").alias("province"),
        S.blank_to(F.col("district"), "Unknown").alias("district"),
        role.alias("role"))
    new_children = (children.join(mapping, children[child_fk] == mapping["_old"], "left")
                    .withColumn(child_fk, F.col("_new")).drop("_old", "_new"))
    return new_users, new_children


def random_sample(df: DataFrame, n: int = 2, seed: int = 42, key: str = "account_id") -> DataFrame:
    """``n`` random rows: those with the smallest hashes of seed and key. Every row
    is as likely as another, and a rerun, or a task repeated after an executor
    loss, picks the same ones (TakeOrderedAndProject: each task keeps n
    candidates, no full sort)."""
    return df.orderBy(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256), key).limit(n)
