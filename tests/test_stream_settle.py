"""Streaming settlement: ids in keyed state, balances folded by epochs."""

from __future__ import annotations

import datetime as dt
import decimal
import random

import pytest

from remitlens.session import scratch_path
from remitlens.streaming import pipeline, settle

from .test_properties import _settle_brute

D = decimal.Decimal
T0 = dt.datetime(2024, 1, 1)
OPENING = {1: D("50.00"), 2: D("9.00"), 3: D("0.00")}
EVENT = "transactionId string, fromAccountId string, toAccountId string, amount decimal(18,2), status string, timestamp timestamp"


def _batches(seed, n, rows=14):
    """Transfers of n micro-batches: ids of earlier and of the same batch come
    again, much later ones too; bad amounts, unknown senders and receivers."""
    rng = random.Random(seed)
    made, out = {}, []
    for _ in range(n):
        batch = []
        for _ in range(rows):
            if made and rng.random() < 0.3:
                batch.append(rng.choice(list(made.values())))
                continue
            i = len(made)
            amount = rng.choice([None, D(-1), D(0), D(rng.randrange(1, 3000)) / 100, D(rng.randrange(1, 900)) / 100])
            made[i] = (i, rng.choice([1, 1, 1, 2, 3, 7]), rng.choice([1, 2, 3, 99]), amount, T0 + dt.timedelta(minutes=i))
            batch.append(made[i])
        out.append(batch)
    return out


def _told(batches):
    """The batches settled in turn, each against the ledger so far."""
    balances, want = dict(OPENING), {}
    for batch in batches:
        new = list({t[0]: t for t in batch if t[0] not in want}.values())
        told = _settle_brute(new, balances)
        for i, s, t, a, _ in new:
            if told[i][0] == "SUCCESS":
                balances[s] -= a
                balances[t] += a
        want |= told
    return want, balances


def _accounts(spark):
    return spark.createDataFrame(list(OPENING.items()), "account_id long, balance decimal(18,2)")


def _decisions(spark, store):
    rows = spark.read.parquet(f"{store}/decisions").collect()
    assert len({r["transaction_id"] for r in rows}) == len(rows)
    return {r["transaction_id"]: (r["status"], r["reason"]) for r in rows}


@pytest.mark.parametrize("seed,fold_every", [(1, 3), (2, 32)])
def test_stream_equals_the_batches_in_turn_over_restarts(spark, seed, fold_every):
    batches = _batches(seed, 8)
    path, store, checkpoint = (scratch_path(spark, f"settle-{x}") for x in ("in", "store", "ckpt"))
    for part in (batches[:3], batches[3:4], batches[4:]):  # the stream stops and starts again twice
        for batch in part:
            frame = spark.createDataFrame([(str(i), str(s), str(t), a, "PENDING", ts) for i, s, t, a, ts in batch], EVENT)
            pipeline.write_event_files(frame.coalesce(1), path, mode="append")
        source = pipeline.transfer_source(spark, kind="files", path=path, max_files_per_trigger=1)
        settle.stream_settle(source, _accounts(spark), store, checkpoint, fold_every=fold_every).awaitTermination()
    want, balances = _told(batches)
    assert _decisions(spark, store) == want
    net = {r["account_id"]: r["delta"] for r in settle.net_before(spark, store, len(batches), fold_every).collect()}
    assert {k: OPENING[k] + net.get(k, 0) for k in OPENING} == balances


def test_a_batch_reads_no_more_as_the_stream_goes_on(spark):
    store, fold_every, batches = scratch_path(spark, "settle-store"), 4, _batches(3, 11, rows=5)
    files, done = [], set()
    for b, batch in enumerate(batches):
        new = [t for t in batch if t[0] not in done]
        done |= {t[0] for t in new}
        frame = spark.createDataFrame([(i, s, t, a, "PENDING", ts) for i, s, t, a, ts in new],
                                      "transaction_id long, from_id long, to_id long, amount decimal(18,2), "
                                      "status string, created_at timestamp_ntz")
        for _ in range(1 + b % 2):  # a batch that is repeated after a failure changes nothing, the fold included
            settle.settle_micro_batch(frame, _accounts(spark), store, b, fold_every)
        folders = {f.rsplit("/", 1)[0] for f in settle.net_before(spark, store, b + 1, fold_every).inputFiles()}
        files.append(len(folders))
    assert max(files) <= fold_every + 1
    want, balances = _told(batches)
    assert _decisions(spark, store) == want
    net = {r["account_id"]: r["delta"] for r in settle.net_before(spark, store, len(batches), fold_every).collect()}
    assert {k: OPENING[k] + net.get(k, 0) for k in OPENING} == balances


def test_ids_are_kept_by_the_state_store(spark):
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")
