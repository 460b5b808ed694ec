"""Streams: repeats however late, malformed events, velocity rules, one scan."""

from __future__ import annotations

import datetime as dt
import decimal
import random
from collections import Counter, defaultdict

from remitlens.operators import facts
from remitlens.session import scratch_path
from remitlens.streaming import events, pipeline
from remitlens.streaming.events import event_to_fact

EVENT = ("transactionId string, fromAccountNumber string, fromDistrict string, toAccountNumber string, "
         "amount decimal(18,2), status string, timestamp timestamp")
T0 = dt.datetime(2024, 1, 1, 10)


def _write(spark, path, rows):
    pipeline.write_event_files(spark.createDataFrame(rows, EVENT).coalesce(1), path, mode="append")


def _event(i, minutes, sender="a", receiver="b", amount=1, district="D"):
    return (str(i), sender, district, receiver, None if amount is None else decimal.Decimal(amount), "SUCCESS", T0 + dt.timedelta(minutes=minutes))


def test_a_repeat_hours_late_gives_no_facts(spark):
    path, out, checkpoint = (scratch_path(spark, f"late-{x}") for x in ("in", "out", "ckpt"))
    for batch in ([_event(1, 0), _event(2, 1), _event(1, 0)], [_event(3, 300)], [_event(1, 0), _event(2, 301), _event(4, 2)]):
        _write(spark, path, batch)  # the last batch repeats with the old and with a new time; 4 is new and late
        source = pipeline.transfer_source(spark, kind="files", path=path, max_files_per_trigger=1)
        pipeline.stream_fact_ingest(source, out, checkpoint, available_now=True).awaitTermination()
    assert Counter(r["transaction_id"] for r in spark.read.parquet(out).collect()) == {"1": 2, "2": 2, "3": 2, "4": 2}


def test_a_repeat_hours_late_gives_no_second_notification(spark):
    path, out, checkpoint = (scratch_path(spark, f"notify-{x}") for x in ("in", "out", "ckpt"))
    schema = ("transactionId string, fromUserId string, toUserId string, amount double, description string, status string, "
              "failReason string, processedAt timestamp_ntz")

    def result(i, status, minutes):
        return (str(i), "u", "v", 5.0, None, status, None, T0 + dt.timedelta(minutes=minutes))

    for batch in ([result(1, "COMPLETED", 0), result(2, "FAILED", 0)], [result(1, "COMPLETED", 200)],
                  [result(2, "FAILED", 0), result(1, "REVERSED", 400)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        pipeline.stream_to_table(events.notification_rows(pipeline.stream_results_once(stream)), out, checkpoint)
    got = Counter((r["transaction_id"], r["user_id"], r["type"]) for r in spark.read.parquet(out).collect())
    assert got == {("1", "u", "TRANSACTION"): 2, ("1", "v", "TRANSACTION"): 1, ("2", "u", "ALERT"): 1}


def test_malformed_events_are_kept_apart(spark):
    path, out = scratch_path(spark, "lines"), scratch_path(spark, "quarantine")
    good = ['{"transactionId":"1","amount":2.5}', '"{\\"transactionId\\":\\"2\\",\\"amount\\":3}"', '{"transactionId":"3"}']
    bad = ['{"transactionId":"4","amount":', "[]", "null", '{"amount":1}', '{"transactionId":"5","amount":"x"}', "text", '"',
           '{"transactionId":"6","timestamp":"yesterday"}']
    spark.createDataFrame([(v,) for v in good + bad + [" "]], "value string").write.text(path)
    source = pipeline.transfer_source(spark, kind="files", path=path, with_malformed=True)
    pipeline.stream_quarantine(source, out, scratch_path(spark, "quarantine-ckpt")).awaitTermination()
    rows = spark.read.parquet(out)
    assert sorted(r["malformed"] for r in rows.where("kind = 'malformed'").collect()) == sorted(bad)
    assert {r["transactionId"]: r["amount"] for r in rows.where("kind = 'good'").collect()} == {"1": 2.5, "2": 3, "3": None}


def _velocity_brute(rows, large, per_minute, per_hour, fan):
    rapid, big, out = defaultdict(set), defaultdict(set), defaultdict(set)
    for i, sender, district, receiver, amount, _, ts in rows:
        minute, hour = ts.replace(second=0), ts.replace(minute=0, second=0)
        rapid[minute, district, sender].add(i)
        if amount >= large:
            big[hour, district, sender].add(i)
        out[hour, district, sender].add(receiver)
    return sorted([("RAPID_FIRE", *k, len(v)) for k, v in rapid.items() if len(v) >= per_minute]
                  + [("LARGE_AMOUNT", *k, len(v)) for k, v in big.items() if len(v) >= per_hour]
                  + [("FAN_OUT", *k, len(v)) for k, v in out.items() if len(v) >= fan])


def test_velocity_rules_in_one_stream(spark):
    rng = random.Random(5)
    rows = [_event(i, m, rng.choice("aab"), rng.choice("uvwxyz"), rng.choice([1, 60, 70]), rng.choice(["D", "E"]))
            for i, m in enumerate(sorted(rng.randrange(300) for _ in range(200)))]
    path, out, checkpoint = (scratch_path(spark, f"velocity-{x}") for x in ("in", "out", "ckpt"))
    for lo in range(0, len(rows), 60):  # events up to nine minutes late, and repeats
        part = rows[lo:lo + 60]
        early = [r for r in rows[lo + 60:lo + 64] if r[-1] <= part[-1][-1] + dt.timedelta(minutes=9)]
        _write(spark, path, early + part + rng.sample(part, 5))
    _write(spark, path, [_event("end", 5000, None, None, None, None)])
    source = pipeline.transfer_source(spark, kind="files", path=path, max_files_per_trigger=1)
    alerts = pipeline.velocity_alerts(facts.fact_geo_explode(event_to_fact(source)), large_threshold=60,
                                      large_min_per_hour=3, min_counterparties=4)
    plan = alerts._jdf.queryExecution().analyzed().toString()
    assert plan.count("StreamingRelation") == 1 and "collect_set" not in plan
    pipeline.stream_to_table(alerts, out, checkpoint)
    got = sorted((r["kind"], r["window_start"], r["district"], r["owner_account_id"], r["n"]) for r in spark.read.parquet(out).collect())
    assert got == _velocity_brute(rows, 60, 2, 3, 4) and {r[0] for r in got} == {"RAPID_FIRE", "LARGE_AMOUNT", "FAN_OUT"}


def test_an_event_is_parsed_once_for_the_velocity_rules(spark):
    """Neither the filter of good events nor the rules repeat the parsing of the text."""
    values = spark.createDataFrame([('{"transactionId":"1","amount":2.5}',)], "value string")
    good = pipeline.parsed_events(values).where("malformed IS NULL").drop("malformed")
    assert [r["transactionId"] for r in good.collect()] == ["1"]
    alerts = pipeline.velocity_alerts(facts.fact_geo_explode(event_to_fact(good)))
    plan = alerts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("columnNameOfCorruptRecord") == 1 and "lambdafunction" not in plan
