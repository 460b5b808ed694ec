"""Hand-made edge rows (FIXTURES §3) and properties, checked against
brute-force Python where no SQL oracle applies."""

from __future__ import annotations

import datetime as dt
import decimal
import os
import random

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens.functions import scalars as S
from remitlens.functions import ranges
from remitlens.operators import flow, growth, history, ledger, peak, ranking, recipients, risk, vip
from remitlens.session import scratch_path
from remitlens.sources import fact_store
from remitlens.streaming import events

from .conftest import SF_SMALL

D = decimal.Decimal


def _one(spark, col, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(col(F.col("v")).alias("o")).first()["o"]


# ---------------------------------------------------------------- scalars

def test_normalize_location_cases(spark):
    cases = {
        "Hà Nội": "HaNoi", "thừa thiên huế": "ThuaThienHue", "Đắk Lắk": "DakLak", "Quận 1": "Quan",
        "Quận 3": "Quan", "Đà Nẵng": "DaNang", "123": "", "   ": "Unknown", None: "Unknown",
        "  hồ   chí  minh ": "HoChiMinh",
    }
    # The same place written decomposed (NFD) must normalise identically.
    import unicodedata
    cases[unicodedata.normalize("NFD", "Đà Nẵng")] = "DaNang"
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r["v"]: r["o"] for r in df.select("v", S.normalize_location(F.col("v")).alias("o")).collect()}
    assert got == cases


def test_non_accent_and_region(spark):
    assert _one(spark, S.non_accent, "Thừa Thiên Huế – Đà Nẵng") == "Thua Thien Hue – Da Nang"
    assert _one(spark, S.non_accent, "Ça") == "Ça"  # not a Vietnamese letter: kept
    assert _one(spark, S.region_of_province, "Hà Nội") == "NORTH"
    assert _one(spark, S.region_of_province, "Đà Nẵng") == "MID"
    assert _one(spark, S.region_of_province, "Cần Thơ") == "SOUTH"
    assert _one(spark, S.region_of_province, None) == "CENTRAL"


def test_status_norm_and_success(spark):
    df = spark.createDataFrame([("",), (None,), ("success",), (" COMPLETED ",), ("failed",)], "v string")
    got = [(r["n"], r["ok"]) for r in df.select(S.status_norm(F.col("v")).alias("n"),
                                                S.is_success(F.col("v")).alias("ok")).collect()]
    assert got == [("UNKNOWN", False), ("UNKNOWN", False), ("SUCCESS", True), ("COMPLETED", True),
                   ("FAILED", False)]


def test_ts_parse_shapes(spark):
    rows = ["2024-01-05T10:30", "2024-01-05T10:30:01", "2024-01-05T10:30:01.123", "bad", " 2024-01-05T10:30:01 "]
    df = spark.createDataFrame([(r,) for r in rows], "v string")
    got = df.select(S.ts_parse(F.col("v")).alias("l"), S.ts_parse(F.col("v"), strict=True).alias("s")).collect()
    assert [r["l"] for r in got] == [dt.datetime(2024, 1, 5, 10, 30), dt.datetime(2024, 1, 5, 10, 30, 1),
                                     dt.datetime(2024, 1, 5, 10, 30, 1, 123000), None,
                                     dt.datetime(2024, 1, 5, 10, 30, 1)]
    assert [r["s"] for r in got] == [None, dt.datetime(2024, 1, 5, 10, 30, 1), None, None,
                                     dt.datetime(2024, 1, 5, 10, 30, 1)]


def test_round2_java_ties(spark):
    df = spark.createDataFrame([(-0.125,), (0.125,), (-2.5 / 100,), (12.345,)], "x double")
    got = [r["r"] for r in df.select(S.round2_java(F.col("x")).alias("r")).collect()]
    # Math.round rounds ties toward +infinity: -12.5 → -12.
    assert got == [-0.12, 0.13, -0.02, 12.35]


def test_money_format_half_up(spark):
    df = spark.createDataFrame([(D("2.50"),), (D("1234567.49"),), (None,)], "a decimal(18,2)")
    got = [r["t"] for r in df.select(S.money_format(F.col("a")).alias("t")).collect()]
    assert got == ["3 VND", "1,234,567 VND", "0 VND"]


def test_json_unwrap(spark):
    df = spark.createDataFrame([('{"status": "FAILED"}',), ('"{\\"status\\": \\"COMPLETED\\"}"',)], "v string")
    got = [r["s"] for r in df.select(F.from_json(S.json_unwrap(F.col("v")), "status string")
                                     .getField("status").alias("s")).collect()]
    assert got == ["FAILED", "COMPLETED"]


def test_period_ranges_iso_week(spark):
    df = spark.createDataFrame([("2021-W01",), ("2020-W53",), ("2024-W01",)], "label string")
    s, e = ranges.range_by_granularity(F.col("label"), "week")
    got = [(r["s"], r["e"]) for r in df.select(s.alias("s"), e.alias("e")).collect()]
    assert got[0] == (dt.datetime(2021, 1, 4), dt.datetime(2021, 1, 10, 23, 59, 59))
    assert got[1] == (dt.datetime(2020, 12, 28), dt.datetime(2021, 1, 3, 23, 59, 59))
    assert got[2] == (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 7, 23, 59, 59))


# ---------------------------------------------------------------- fact store / CSV scan

def test_scan_fact_csv_skips_bad_lines(spark):
    path = scratch_path(spark, "csv-edge")
    d = f"{path}/province=HaNoi/district=CauGiay/year=2024/quarter=Q1"
    os.makedirs(d)
    lines = [
        "",
        "transaction_id,owner_user_id,owner_account_id,direction,counterparty_account_id,amount,status,"
        "created_at,province,district,year,quarter,month",
        "t1,u1,a1,OUT,a2,250000.00,COMPLETED,2024-01-05T10:30,HaNoi,CauGiay,2024,Q1,2024-01",
        "  t2,u1,a1,OUT,a2,100.50,success,2024-01-05T10:30:01.123,HaNoi,CauGiay,2024,Q1,2024-01  ",
        "t3,u1,a1,OUT,a2,x,FAILED,2024-01-05T10:30:01,HaNoi,CauGiay,2024,Q1,2024-01",
        "t4,u1,a1,OUT,a2,5.00,FAILED",
        "t5,u1,a1,IN,a3,7.00,,bad,HaNoi,CauGiay,2024,Q1,2024-01",
    ]
    with open(f"{d}/part-0.csv", "w") as fh:
        fh.write("\n".join(lines) + "\n\n")
    rows = {r["transaction_id"]: r for r in fact_store.scan_fact_csv(spark, path).collect()}
    assert sorted(rows) == ["t1", "t2", "t5"]
    assert rows["t1"]["amount"] == D("250000.00") and rows["t1"]["created_at"] == dt.datetime(2024, 1, 5, 10, 30)
    assert rows["t2"]["created_at"] == dt.datetime(2024, 1, 5, 10, 30, 1, 123000)
    assert rows["t5"]["created_at"] is None and rows["t5"]["status"] == ""
    assert rows["t1"]["province"] == "HaNoi" and rows["t1"]["year"] == 2024


def test_partition_values_blank_and_numeric(spark):
    fact = spark.createDataFrame(
        [("1", "", "01", 2024, "Q1", D("1.00"))],
        "transaction_id string, province string, district string, year int, quarter string, amount decimal(18,2)")
    path = scratch_path(spark, "pv")
    fact_store.write_fact_partitioned(fact, path)
    r = fact_store.read_fact_parquet(spark, path).first()
    assert r["province"] == "Unknown" and r["district"] == "01"


def test_replace_partitions_dynamic(spark):
    schema = "transaction_id string, province string, district string, year int, quarter string, v int"
    a = spark.createDataFrame([("1", "A", "d", 2024, "Q1", 1), ("2", "B", "d", 2024, "Q1", 2)], schema)
    path = scratch_path(spark, "replace")
    fact_store.write_fact_partitioned(a, path)
    fact_store.replace_partitions(spark.createDataFrame([("3", "A", "d", 2024, "Q1", 3)], schema), path)
    got = sorted(r["transaction_id"] for r in fact_store.read_fact_parquet(spark, path).collect())
    assert got == ["2", "3"]


# ---------------------------------------------------------------- flows / risk

FACT_SCHEMA = ("transaction_id string, owner_user_id string, owner_account_id string, direction string, "
               "counterparty_account_id string, amount decimal(18,2), status string, created_at timestamp_ntz, "
               "province string, district string, year int, quarter string, month string")


def _fact_row(tid, direction, prov, dist, amount, status, ts, acct="a1", cp="a2", user="u1"):
    return (tid, user, acct, direction, cp, D(amount), status, ts, prov, dist, ts.year,
            f"Q{(ts.month - 1) // 3 + 1}", ts.strftime("%Y-%m"))


def test_flow_join_missing_side_and_duplicates(spark):
    t = dt.datetime(2024, 1, 1, 10, 0)
    rows = [
        _fact_row("x", "OUT", "HaNoi", "d", "10.00", "SUCCESS", t),
        _fact_row("x", "IN", "DaNang", "d", "10.00", "SUCCESS", t),
        _fact_row("y", "OUT", "HaNoi", "d", "5.00", "SUCCESS", t),  # no IN side
        _fact_row("z", "OUT", "HaNoi", "d", "1.00", "SUCCESS", t),
        _fact_row("z", "OUT", "Hue", "d", "2.00", "SUCCESS", t + dt.timedelta(seconds=1)),  # latest wins
        _fact_row("z", "IN", "DaNang", "d", "2.00", "SUCCESS", t),
    ]
    f = spark.createDataFrame(rows, FACT_SCHEMA)
    got = {(r["from_province"], r["to_province"]): r["total"] for r in flow.province_flow(f, 10).collect()}
    assert got == {("HaNoi", "DaNang"): 10.0, ("Hue", "DaNang"): 2.0}
    assert flow.province_flow(f, 0).count() == 0


def test_risk_measures_brute_force(spark):
    base = dt.datetime(2024, 1, 1, 10, 0)
    rng = random.Random(3)
    rows = []
    for i in range(400):
        ts = base + dt.timedelta(seconds=rng.randrange(0, 3 * 3600))
        rows.append(_fact_row(str(i), rng.choice(["OUT", "IN"]), "P", rng.choice(["d1", "d2", " "]),
                              f"{rng.randrange(1, 100)}.00", rng.choice(["SUCCESS", "FAILED", "REVERSED", " failed"]),
                              ts, acct=rng.choice(["a1", "a2", "a3"]), cp=rng.choice(["c1", "c2", "c3", "c4"])))
    f = spark.createDataFrame(rows, FACT_SCHEMA)
    got = {r["district"]: r.asDict() for r in risk.district_measures(f, 60, 2).collect()}
    # brute force
    from collections import Counter, defaultdict
    exp = defaultdict(lambda: Counter())
    large, rapid, fan = Counter(), Counter(), set()
    for r in rows:
        d = r[9].strip() or "UNKNOWN"
        st = r[6].strip().upper()
        exp[d]["total"] += 1
        exp[d]["failed"] += st in ("FAILED", "REVERSED")
        exp[d]["reversed"] += st == "REVERSED"
        if r[3] == "OUT":
            ts = r[7]
            if r[5] >= 60:
                large[(d, r[2], ts.replace(minute=0, second=0))] += 1
            rapid[(d, r[2], ts.replace(second=0))] += 1
            fan.add((d, r[2], ts.replace(minute=0, second=0), r[4]))
    for (d, _, _), c in large.items():
        exp[d]["large_amount"] += c if c >= 2 else 0
    for (d, _, _), c in rapid.items():
        exp[d]["rapid_fire"] += c if c >= 2 else 0
    for (d, _, _, _) in fan:
        exp[d]["fan_out"] += 1
    for d, m in exp.items():
        for k in risk.MEASURES:
            assert got[d][k] == m[k], (d, k)


# ---------------------------------------------------------------- growth / peak / VIP

def test_growth_negative_tie_and_missing_quarter(spark):
    schema = "year int, quarter string, total_amount double, tx_count bigint"
    # amount 800 → 799: -0.125 % → Java Math.round gives -0.12
    s = spark.createDataFrame([(2024, "Q1", 800.0, 8), (2024, "Q2", 799.0, 8)], schema)
    r = growth.quarter_growth(s).first()
    assert r["growth_amount_pct"] == -0.12 and r["growth_count_pct"] == 0.0
    only_q1 = spark.createDataFrame([(2024, "Q1", 800.0, 8)], schema)
    assert growth.quarter_growth(only_q1).count() == 0


def test_quarter_stats_reads_numeric_quarters_and_drops_blank_status(spark):
    t = dt.datetime(2024, 2, 1)
    rows = [_fact_row("1", "OUT", "P", "d", "10.00", "success", t), _fact_row("2", "OUT", "P", "d", "5.00", "", t),
            _fact_row("3", "IN", "P", "d", "1.00", "FAILED", t)]
    f = spark.createDataFrame(rows, FACT_SCHEMA).withColumn("quarter", F.lit("1"))
    r = growth.quarter_stats(f, 2024).first()
    assert (r["quarter"], r["tx_count"], r["success_count"], r["total_amount"], r["success_rate"]) == \
        ("Q1", 2, 1, 11.0, 50.0)


def test_daily_chart_february(spark):
    t = dt.datetime(2023, 2, 3, 9, 15)
    f = spark.createDataFrame([_fact_row("1", "OUT", "P", "d", "10.00", "COMPLETED", t)], FACT_SCHEMA)
    totals = peak.peak_totals(f, "2023-02")
    chart = peak.daily_chart(spark, totals, "2023-02").collect()
    assert len(chart) == 28 and sum(r["total_transactions"] for r in chart) == 1
    assert len(peak.hourly_chart(spark, totals).collect()) == 24
    empty = peak.peak_window(spark, peak.peak_totals(f, "2023-03")).collect()
    assert {r["label"] for r in empty} == {peak.NO_DATA}


def test_percent_rank_global_matches_window(spark):
    rng = random.Random(7)
    vals = [(i, float(rng.randrange(0, 40))) for i in range(500)]  # many ties
    df = spark.createDataFrame(vals, "id long, total double")
    got = {r["id"]: r["pct_rank"] for r in ranking.percent_rank_global(df, "total", partitions=6).collect()}
    exp = {r["id"]: r["p"] for r in df.select("id", F.percent_rank().over(Window.orderBy("total")).alias("p"))
           .collect()}
    assert got == exp


def test_vip_single_customer_excluded(spark):
    df = spark.createDataFrame([(1, "A", "100", D("5.00"), 1)],
                               "user_id long, full_name string, account_number string, "
                               "total_amount decimal(18,2), total_txn long")
    assert vip.vip_percent_rank(df).count() == 0


# ---------------------------------------------------------------- ledger

def test_settle_rejected_then_smaller_accepted(spark):
    accounts = spark.createDataFrame([(1, D("100.00")), (2, D("0.00"))], "account_id long, balance decimal(18,2)")
    t = dt.datetime(2024, 1, 1)
    tx = spark.createDataFrame(
        [(10, 1, 2, D("150.00"), "PENDING", t), (11, 1, 2, D("60.00"), "PENDING", t + dt.timedelta(seconds=1)),
         (12, 1, 2, D("50.00"), "PENDING", t + dt.timedelta(seconds=2)),
         (13, 1, 99, D("10.00"), "PENDING", t + dt.timedelta(seconds=3)),
         (14, 1, 2, D("40.00"), "PENDING", t + dt.timedelta(seconds=4)),
         (15, 2, 1, D("5.00"), "PENDING", t), (16, 1, 2, D("1.00"), "SUCCESS", t)],
        "transaction_id long, from_id long, to_id long, amount decimal(18,2), status string, created_at timestamp_ntz")
    got = {r["transaction_id"]: (r["status"], r["reason"]) for r in ledger.settle_batch(tx, accounts).collect()}
    assert got == {10: ("FAILED", "INSUFFICIENT_BALANCE"), 11: ("SUCCESS", None),
                   12: ("FAILED", "INSUFFICIENT_BALANCE"), 13: ("FAILED", "RECEIVER_NOT_FOUND"),
                   14: ("SUCCESS", None), 15: ("FAILED", "INSUFFICIENT_BALANCE")}
    settled = ledger.settle_batch(tx, accounts)
    bal = {r["account_id"]: r["balance"] for r in
           ledger.ledger_balance(accounts, ledger.ledger_movements(settled)).collect()}
    assert bal == {1: D("0.00"), 2: D("100.00")}  # money is conserved


def test_running_sum_global_matches_window(spark):
    rng = random.Random(11)
    rows = [(rng.choice([1, 1, 1, 2, 3]), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(10**5)),
             i, D(rng.randrange(-500, 500)) / 100) for i in range(600)]
    df = spark.createDataFrame(rows, "account_id long, created_at timestamp_ntz, transaction_id long, "
                                     "delta decimal(18,2)")
    got = {r["transaction_id"]: r["cum"] for r in
           ledger.running_sum_global(df, "account_id", ["created_at", "transaction_id"], "delta", "cum").collect()}
    w = Window.partitionBy("account_id").orderBy("created_at", "transaction_id")
    exp = {r["transaction_id"]: r["cum"] for r in df.select("transaction_id", F.sum("delta").over(w).alias("cum"))
           .collect()}
    assert got == exp


# ---------------------------------------------------------------- model properties

def test_explode_conserves_money(spark):
    from .conftest import SF_SMALL
    from remitlens.plans.model_frames import Frames
    f = Frames(spark, SF_SMALL).fact
    sums = {r["direction"]: r["s"] for r in f.groupBy("direction").agg(F.sum("amount").alias("s")).collect()}
    assert sums["OUT"] == sums["IN"]


def test_notifications_per_status(spark):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in
                           ["transactionId", "fromUserId", "toUserId", "description", "status", "failReason"]]
                          + [T.StructField("amount", T.DecimalType(18, 2)),
                             T.StructField("processedAt", T.TimestampNTZType())])
    t = dt.datetime(2024, 1, 1)
    r = spark.createDataFrame([("1", "u1", "u2", "x", "COMPLETED", None, D("1000.00"), t),
                               ("2", "u1", "u2", None, "FAILED", None, D("5.00"), t),
                               ("3", "u1", "u2", None, "REVERSED", None, D("5.00"), t),
                               ("4", "u1", "u2", None, "PENDING", None, D("5.00"), t)], schema)
    n = events.notification_rows(r).collect()
    assert sorted((x["transaction_id"], x["user_id"], x["type"]) for x in n) == [
        ("1", "u1", "TRANSACTION"), ("1", "u2", "TRANSACTION"), ("2", "u1", "ALERT"), ("3", "u1", "TRANSACTION")]
    assert any("1,000 VND" in x["message"] for x in n)
    assert any(x["message"].endswith("Lý do: Không rõ") for x in n)


def test_top_recipients_bounded_per_user(spark):
    rows = [(1, f"acc{i}", 10 - i % 7, D(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "user_id long, account_number string, transfer_count long, "
                                     "total_amount decimal(18,2)").withColumn("full_name", F.col("account_number"))
    top = recipients.top_recipients(df, 5).collect()
    assert len(top) == 5 and [r["rank"] for r in top] == [1, 2, 3, 4, 5]


def test_recipient_candidates_exact_with_ties(spark):
    # Many rows tie on (count, amount) at the cut, so names decide the order:
    # pre-trimming with rank() <= k must give the same top k as ranking all rows.
    rows = [(u, f"acc{u}-{i}", [3, 2, 2, 2, 2, 2, 1][i % 7], D([9, 5, 5, 5, 5, 5, 1][i % 7]), f"Name {(i * 7) % 13}")
            for u in (1, 2) for i in range(20)]
    df = spark.createDataFrame(rows, "user_id long, account_number string, transfer_count long, "
                                     "total_amount decimal(18,2), full_name string")
    cand = recipients.recipient_candidates(df.drop("full_name"), 5).join(
        df.select("user_id", "account_number", "full_name"), ["user_id", "account_number"])
    assert cand.count() < df.count()
    full = sorted(tuple(r) for r in recipients.top_recipients(df, 5).collect())
    trimmed = sorted(tuple(r) for r in recipients.top_recipients(cand, 5).collect())
    assert full == trimmed and len(full) == 10


def test_percent_rank_global_hot_value_and_nulls(spark):
    # A third of the rows share one value, a few are null (sorted first).
    rows = [(i, 7.0 if i % 3 == 0 else (None if i % 50 == 1 else float(i % 23))) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, total double")
    got = {r["id"]: r["pct_rank"] for r in ranking.percent_rank_global(df, "total", partitions=5).collect()}
    exp = {r["id"]: r["p"] for r in df.select("id", F.percent_rank().over(Window.orderBy("total")).alias("p"))
           .collect()}
    assert len(got) == 600 and got == exp


def test_running_sum_global_hot_key_nulls_and_sparse_ranges(spark):
    # One key spans many ranges, a null key sorts first, and the tiny second
    # frame leaves empty range partitions between the rows of one key.
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        rng = random.Random(5)
        rows = [(None if i % 97 == 0 else (7 if i % 3 else rng.randrange(20)),
                 dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(10**4)), i,
                 D(rng.randrange(-900, 900)) / 100) for i in range(900)]
        small = [(1, dt.datetime(2024, 1, 1), 1, D("1.00")), (1, dt.datetime(2024, 1, 2), 2, D("2.00")),
                 (1, dt.datetime(2024, 1, 3), 3, D("4.00"))]
        for data in (rows, small):
            df = spark.createDataFrame(data, "account_id long, created_at timestamp_ntz, transaction_id long, "
                                             "delta decimal(18,2)")
            got = {r["transaction_id"]: r["cum"] for r in
                   ledger.running_sum_global(df, "account_id", ["created_at", "transaction_id"], "delta",
                                             "cum").collect()}
            w = Window.partitionBy("account_id").orderBy("created_at", "transaction_id")
            exp = {r["transaction_id"]: r["cum"] for r in
                   df.select("transaction_id", F.sum("delta").over(w).alias("cum")).collect()}
            assert len(got) == len(data) and got == exp
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_history_account_keeps_only_existing_accounts(spark):
    t = dt.datetime(2024, 1, 1)
    tx = spark.createDataFrame([(1, 10, 20, D("5.00"), "SUCCESS", t), (2, 10, 99, D("7.00"), "FAILED", t),
                                (3, 10, 10, D("1.00"), "SUCCESS", t)],
                               "transaction_id long, from_id long, to_id long, amount decimal(18,2), "
                               "status string, created_at timestamp_ntz")
    accounts = spark.createDataFrame([(10,), (20,)], "account_id long")
    got = sorted((r["account_id"], r["transaction_id"]) for r in history.history_account(tx, accounts).collect())
    # 99 is not an account; the self transfer appears once for its account.
    assert got == [(10, 1), (10, 2), (10, 3), (20, 1)]


def test_fold_rows_matches_plain_loop():
    # Long histories with accept runs, reject runs and quick alternation.
    import numpy as np
    rng = random.Random(3)
    for trial in range(60):
        m = rng.choice([1, 5, 70, 300, 3000])
        hi = rng.choice([10, 100, 1000])
        amt = np.array([rng.randrange(0, hi) for _ in range(m)], dtype=np.int64)
        known = np.array([rng.random() > 0.2 for _ in range(m)], dtype=bool)
        bal0 = rng.randrange(0, hi * rng.choice([1, 5, 50, 500]))
        exp, bal = [], bal0
        for a, k in zip(amt.tolist(), known.tolist()):
            exp.append(bal >= a)
            if bal >= a and k:
                bal -= a
        ok = np.zeros(m, dtype=bool)
        assert ledger._fold_rows(amt, known, bal0, ok) == bal
        assert ok.tolist() == exp


def test_self_transfer_in_statistics_and_monthly(spark):
    # Quirk q12: a self transfer counts in neither total_in nor total_out of the
    # statistics, but on both sides of the monthly statement.
    t = dt.datetime(1997, 3, 5, 10, 0)
    tx = spark.createDataFrame([(1, 10, 10, D("7.00"), "SUCCESS", t), (2, 10, 20, D("3.00"), "SUCCESS", t)],
                               "transaction_id long, from_id long, to_id long, amount decimal(18,2), "
                               "status string, created_at timestamp_ntz")
    accounts = spark.createDataFrame([(10, 1, "100000000010"), (20, 2, "100000000020")],
                                     "account_id long, user_id long, account_number string")
    sides = history.transfer_sides(tx, accounts)
    stats = {r["user_id"]: r for r in history.stats_summary(history.participants(sides)).collect()}
    assert stats[1]["total_transactions"] == 2
    assert (stats[1]["total_in"], stats[1]["total_out"]) == (0.0, 3.0)
    month = {r["user_id"]: r for r in history.monthly_summary(sides, "1997-03").collect()}
    assert (month[1]["total_received"], month[1]["total_sent"]) == (7.0, 10.0)
    assert month[2]["total_received"] == 3.0


def test_empty_quarter_gives_empty_reports(spark):
    t = dt.datetime(2024, 2, 1, 9, 0)
    f = spark.createDataFrame([_fact_row("1", "OUT", "P", "d", "10.00", "FAILED", t)], FACT_SCHEMA)
    q2 = risk.quarter_slice(f, 2024, "Q2")
    assert q2.count() == 0
    assert risk.district_risk(q2, large_threshold=5, large_min_per_hour=1).count() == 0
    assert risk.district_risk(risk.quarter_slice(f, 2024, "Q1"), large_threshold=5,
                              large_min_per_hour=1).count() == 1


def test_dup_contacts_existing_first_wins_and_nulls(spark):
    from remitlens.operators import lookups
    batch = spark.createDataFrame(
        [(1, "a@x.vn", "0901", "1"), (2, "b@x.vn", "0902", "2"), (3, "b@x.vn", "0901", "3"),
         (4, None, None, "4"), (5, "b@x.vn", None, "5")],
        "seq long, email string, phone string, identity_card string")
    users = spark.createDataFrame([("a@x.vn", "0999", "9"), (None, None, None)],
                                  "email string, phone string, identity_card string")
    got = {r["seq"]: r["violations"] for r in lookups.dup_contacts(batch, users).collect()}
    # row 1 is rejected for its e-mail address, so it does not claim the phone of row 3
    assert got == {1: ["email_exists"], 3: ["email_duplicate_in_batch"], 5: ["email_duplicate_in_batch"]}


def test_fan_out_approximate_is_close(spark):
    from remitlens.plans.model_frames import Frames
    from .conftest import SF_SMALL
    q = risk.quarter_slice(Frames(spark, SF_SMALL).fact, 2024, "Q1")
    exact = {r["district"]: r["fan_out"] for r in risk.fan_out(q).collect()}
    approx = {r["district"]: r["fan_out"] for r in risk.fan_out(q, approximate=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[d] - exact[d]) <= max(2, 0.05 * exact[d]) for d in exact)


# ---------------------------------------------------------------- store, joins, lookups

FACT = ("transaction_id string, owner_user_id string, owner_account_id string, direction string, "
        "counterparty_account_id string, amount decimal(18,2), status string, created_at timestamp_ntz, "
        "province string, district string, year int, quarter string, month string")


def test_text_store_round_trip(spark):
    t = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    rows = [("1", "u", "a", "OUT", "b", D("1.50"), "SUCCESS", t, "Ho Chi Minh, VN", 'D "1"', 2024, "Q1", "2024-01"),
            ("2", None, "a", "IN", None, D("2.00"), "", t, None, " ", 2024, "Q1", "2024-01"),
            ("3", 'say "x", y', "a", "IN", "c\nd", D("3.00"), None, None, "HaNoi", "B", 2024, "Q1", None)]
    path = scratch_path(spark, "round-trip")
    fact_store.write_fact_partitioned(spark.createDataFrame(rows, FACT), path, fmt="csv")
    got = {r["transaction_id"]: r for r in fact_store.scan_fact_csv(spark, path).collect()}
    assert len(got) == 3
    assert (got["1"]["province"], got["1"]["district"], got["1"]["month"]) == ("Ho Chi Minh, VN", 'D "1"', "2024-01")
    assert got["1"]["created_at"] == t and got["1"]["amount"] == D("1.50")
    assert (got["2"]["province"], got["2"]["status"], got["2"]["owner_user_id"]) == ("Unknown", "", "")
    assert (got["3"]["owner_user_id"], got["3"]["counterparty_account_id"]) == ('say "x"  y', "c d")
    assert got["3"]["status"] == "" and got["3"]["created_at"] is None


def test_replace_keeps_the_session_mode_and_delete_clears_a_slice(spark):
    t = dt.datetime(2024, 1, 2)
    row = lambda i, p: (str(i), "u", "a", "OUT", "b", D("1.00"), "SUCCESS", t, p, "B", 2024, "Q1", "2024-01")
    path, key = scratch_path(spark, "replace"), "spark.sql.sources.partitionOverwriteMode"
    fact_store.write_fact_partitioned(spark.createDataFrame([row(1, "X"), row(2, "Y")], FACT), path)
    before = spark.conf.get(key)
    fact_store.replace_partitions(spark.createDataFrame([row(3, "Y")], FACT), path)
    assert spark.conf.get(key) == before
    files = set(fact_store.read_fact_parquet(spark, path).inputFiles())
    ids = lambda: sorted(r["transaction_id"] for r in fact_store.read_fact_parquet(spark, path).collect())
    assert ids() == ["1", "3"]
    assert fact_store.delete_partition(spark, path, "X", "B", 2024, "Q1") and ids() == ["3"]
    assert not fact_store.delete_partition(spark, path, "X", "B", 2024, "Q1")
    assert set(fact_store.read_fact_parquet(spark, path).inputFiles()) < files


def test_flow_join_without_times_and_with_ties(spark):
    from remitlens.operators import facts
    t = dt.datetime(2024, 1, 1)
    rows = [(1, "OUT", None, "A", D("5.00")), (1, "IN", None, "B", D("5.00")),
            (2, "OUT", t, "C", D("7.00")), (2, "OUT", t, "A", D("9.00")), (2, "IN", t, "D", D("1.00")),
            (2, "IN", None, "E", D("2.00")), (3, "IN", t, "F", D("1.00")), (4, "OUT", t, "F", D("1.00")),
            (None, "OUT", t, "F", D("1.00")), (None, "IN", t, "F", D("1.00")), (5, "SIDE", t, "F", D("1.00"))]
    df = spark.createDataFrame(rows, "transaction_id long, direction string, created_at timestamp_ntz, "
                                     "province string, amount decimal(18,2)")
    got = sorted(tuple(r) for r in facts.flow_join(df).collect())
    assert got == [(1, "A", "B", D("5.00")), (2, "A", "D", D("9.00"))]


def test_queries_see_files_added_since(spark, tmp_path):
    from remitlens.plans.model_frames import Frames
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    for name in ("orders", "customer"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    n = Frames(spark, str(tmp_path)).tx.count()
    orders.write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    assert Frames(spark, str(tmp_path)).tx.count() == 2 * n > 0


def test_self_transfer_debits_before_it_credits(spark):
    t = dt.datetime(2024, 1, 1)
    accounts = spark.createDataFrame([(1, D("10.00"))], "account_id long, balance decimal(18,2)")
    settled = spark.createDataFrame([(5, 1, 1, D("4.00"), t, "SUCCESS", None)],
                                    "transaction_id long, from_id long, to_id long, amount decimal(18,2), "
                                    "created_at timestamp_ntz, status string, reason string")
    got = ledger.running_balance(accounts, ledger.ledger_movements(settled)).orderBy("side").collect()
    assert [(r["side"], r["balance_after"]) for r in got] == [(0, D("6.00")), (1, D("10.00"))]


def test_monthly_files_keep_only_good_lines(spark):
    path = scratch_path(spark, "monthly-lines")
    lines = ["id,from,to,amount,status,date", " 1, 7 ,8, 2.50 ,SUCCESS,2024-01-01 ", "2,7,8", "3,7,8,x", "", "4,9,8,1"]
    spark.createDataFrame([("2024-01", x) for x in lines], "month string, value string") \
        .write.partitionBy("month").text(path)
    got = sorted((r["id"], r["from_account"], r["amount"], r["month"]) for r in fact_store.scan_monthly_csv(spark, path).collect())
    assert got == [("1", "7", D("2.50"), "2024-01"), ("4", "9", D("1.00"), "2024-01")]
