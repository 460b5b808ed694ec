"""Property tests: the custom operators against brute force on random inputs
(hot keys, ties and nulls included)."""

from __future__ import annotations

import datetime as dt
import decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from remitlens.operators import ledger, ranking

D = decimal.Decimal
SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
T0 = dt.datetime(2024, 1, 1)


def _settle_brute(pending, balances):
    """Per sender in (created_at, id) order: a missing or not positive amount
    fails; else accept when the balance covers the amount; an accepted transfer
    to an unknown receiver is refunded."""
    out = {}
    for sender in {p[1] for p in pending}:
        bal = balances.get(sender)
        for tid, _, to, amt, ts in sorted((p for p in pending if p[1] == sender), key=lambda p: (p[4], p[0])):
            if amt is None or amt <= 0:
                out[tid] = ("FAILED", "INVALID_AMOUNT")
                continue
            ok = bal is not None and bal >= amt
            known = to in balances
            if ok and known:
                bal -= amt
            reason = None if ok and known else ("INSUFFICIENT_BALANCE" if not ok else "RECEIVER_NOT_FOUND")
            out[tid] = ("SUCCESS" if reason is None else "FAILED", reason)
    return out


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from([1, 1, 1, 2, 3, 7]), st.sampled_from([1, 2, 3, 99]),
                          st.one_of(st.none(), st.integers(-2000, 5000)), st.integers(0, 40), st.booleans()), min_size=1, max_size=40),
       st.lists(st.integers(0, 9000), min_size=3, max_size=3))
def test_settle_batch_matches_sequential_fold(spark, rows, opening):
    balances = {1: D(opening[0]) / 100, 2: D(opening[1]) / 100, 3: D(opening[2]) / 100}
    tx = [(i, s, t, None if a is None else D(a) / 100, "PENDING" if pend else "SUCCESS", T0 + dt.timedelta(minutes=m))
          for i, (s, t, a, m, pend) in enumerate(rows)]
    pending = [(i, s, t, a, ts) for i, s, t, a, st_, ts in tx if st_ == "PENDING"]
    tdf = spark.createDataFrame(tx, "transaction_id long, from_id long, to_id long, amount decimal(18,2), "
                                    "status string, created_at timestamp_ntz")
    adf = spark.createDataFrame([(k, v) for k, v in balances.items()], "account_id long, balance decimal(18,2)")
    got = {r["transaction_id"]: (r["status"], r["reason"]) for r in ledger.settle_batch(tdf, adf).collect()}
    assert got == _settle_brute(pending, balances)


@settings(**SETTINGS)
@given(st.lists(st.one_of(st.none(), st.integers(0, 6), st.just(3)), min_size=1, max_size=60),
       st.integers(1, 7))
def test_percent_rank_global_matches_window(spark, values, parts):
    df = spark.createDataFrame(list(enumerate(values)), "id long, v long")
    got = {r["id"]: r["pct_rank"] for r in ranking.percent_rank_global(df, "v", partitions=parts).collect()}
    exp = {r["id"]: r["p"] for r in df.select("id", F.percent_rank().over(Window.orderBy("v")).alias("p"))
           .collect()}
    assert got == exp


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from([None, 1, 5, 5, 5, 9]), st.integers(0, 20), st.integers(-500, 500)),
                min_size=1, max_size=60),
       st.integers(1, 12))
def test_running_sum_global_matches_window(spark, rows, parts):
    data = [(k, T0 + dt.timedelta(seconds=s), i, D(v) / 100) for i, (k, s, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "account_id long, created_at timestamp_ntz, transaction_id long, "
                                     "delta decimal(18,2)")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {r["transaction_id"]: r["cum"] for r in
               ledger.running_sum_global(df, "account_id", ["created_at", "transaction_id"], "delta",
                                         "cum").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    w = Window.partitionBy("account_id").orderBy("created_at", "transaction_id")
    exp = {r["transaction_id"]: r["cum"] for r in df.select("transaction_id", F.sum("delta").over(w).alias("cum"))
           .collect()}
    assert got == exp


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from([1, 1, 1, 2]), st.integers(1, 4), st.integers(1, 3),
                          st.sampled_from(["An", "an", "Bo", None, "Cu"])), min_size=1, max_size=50),
       st.integers(1, 6))
def test_recipient_candidates_keep_the_exact_top_k(spark, rows, k):
    from remitlens.operators import recipients
    data = [(u, f"acc{i:03d}", c, D(a), n) for i, (u, c, a, n) in enumerate(rows)]
    df = spark.createDataFrame(data, "user_id long, account_number string, transfer_count long, "
                                     "total_amount decimal(18,2), full_name string")
    cand = recipients.recipient_candidates(df.drop("full_name"), k).join(
        df.select("user_id", "account_number", "full_name"), ["user_id", "account_number"])
    full = sorted(tuple(r) for r in recipients.top_recipients(df, k).collect())
    assert sorted(tuple(r) for r in recipients.top_recipients(cand, k).collect()) == full


def _contacts_brute(batch, taken):
    """Rows in turn; an accepted row's values are taken for all later ones."""
    out, claimed = {}, [set(), set(), set()]
    for seq, *values in sorted(batch):
        names = [f"{k}_exists" if v in taken[i] else f"{k}_duplicate_in_batch"
                 for i, (k, v) in enumerate(zip(("email", "phone", "identity_card"), values, strict=True))
                 if v is not None and (v in taken[i] or v in claimed[i])]
        if names:
            out[seq] = names
        else:
            for i, v in enumerate(values):
                claimed[i].add(v)
    return out


_VALUE = st.one_of(st.none(), st.sampled_from("abcdefgh"))
_CONTACTS = "seq long, email string, phone string, identity_card string"


@settings(**SETTINGS)
@given(st.lists(st.tuples(_VALUE, _VALUE, _VALUE), min_size=1, max_size=30), st.lists(st.tuples(_VALUE, _VALUE, _VALUE), max_size=3))
def test_contacts_are_claimed_by_accepted_rows_only(spark, rows, users):
    from remitlens.operators import lookups
    batch = [(i, *r) for i, r in enumerate(rows)]
    taken = [{u[i] for u in users if u[i] is not None} for i in range(3)]
    got = lookups.dup_contacts(spark.createDataFrame(batch, _CONTACTS),
                               spark.createDataFrame(users, "email string, phone string, identity_card string"))
    assert {r["seq"]: r["violations"] for r in got.collect()} == _contacts_brute(batch, taken)


def test_contacts_in_a_chain_and_on_one_value(spark):
    from remitlens.operators import lookups
    # each row shares its phone with the row before, so every second row is accepted; then one value for a third of all rows
    chain = [(i, None, f"p{i // 2}", f"c{(i + 1) // 2}") for i in range(12)]
    batch = chain + [(100 + i, "same", None, None) for i in range(6)]
    got = lookups.dup_contacts(spark.createDataFrame(batch, _CONTACTS), spark.createDataFrame([], _CONTACTS)).collect()
    assert {r["seq"]: r["violations"] for r in got} == _contacts_brute(batch, [set()] * 3)


@settings(**SETTINGS | dict(max_examples=5))
@given(st.lists(st.tuples(st.sampled_from([1, 1, 1, 1, 2, 3]), st.sampled_from([1, 2, 3, 99]),
                          st.one_of(st.integers(1, 40), st.integers(1, 4000)), st.integers(0, 40)), min_size=20, max_size=120),
       st.lists(st.integers(0, 9000), min_size=3, max_size=3), st.sampled_from([3, 7]))
def test_hot_senders_by_segments_match_the_sequential_fold(spark, rows, opening, segment):
    from remitlens.operators import hot_senders
    balances = {k + 1: D(v) / 100 for k, v in enumerate(opening)}
    pending = [(i, s, t, D(a) / 100, T0 + dt.timedelta(minutes=m)) for i, (s, t, a, m) in enumerate(rows)]
    tdf = spark.createDataFrame([(i, s, t, a, "PENDING", ts) for i, s, t, a, ts in pending],
                                "transaction_id long, from_id long, to_id long, amount decimal(18,2), "
                                "status string, created_at timestamp_ntz")
    adf = spark.createDataFrame(list(balances.items()), "account_id long, balance decimal(18,2)")
    before = hot_senders.HOT_ROWS, hot_senders.SEGMENT_ROWS
    hot_senders.HOT_ROWS, hot_senders.SEGMENT_ROWS = 8, segment
    try:
        got = {r["transaction_id"]: (r["status"], r["reason"]) for r in ledger.settle_batch(tdf, adf).collect()}
    finally:
        hot_senders.HOT_ROWS, hot_senders.SEGMENT_ROWS = before
    assert got == _settle_brute(pending, balances)


def test_a_hot_sender_is_cut_into_segments_folded_apart(spark):
    from remitlens.operators import hot_senders
    rows = spark.range(3000).selectExpr("id AS transaction_id", "1L AS from_id", "2L AS to_id",
                                        "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id) AS created_at",
                                        "true AS to_known", "id % 7 + IF(id % 500 = 3, 3000, 0) + 1 AS amount_c", "9000L AS opening_c")
    cut = hot_senders.in_segments(rows, 250)
    starts = {r["_pid"]: r["start"] for r in hot_senders.opening_balances(cut, ledger._closing).collect()}
    assert len(starts) >= 8
    plain = sorted(cut.collect(), key=lambda r: r["transaction_id"])
    bal, seen = 9000, {}
    for r in plain:
        seen.setdefault(r["_pid"], bal)
        if bal >= r["amount_c"]:
            bal -= r["amount_c"]
    assert starts == seen
