import hashlib

import pytest
from pyspark.sql import functions as F

from remitlens.llm import fingerprints as fp
from tests.llm.data import edge_docs, empty_docs, words_of


def brute(rows):
    """Edited texts in descending key order (null keys last)."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    out = []
    for i, (k, t, _) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        cut = len(t) // 3
        out.append((k, len(t), hashlib.sha256((t[:len(t) - cut] + nxt[:cut]).encode()).hexdigest(), nxt))
    return out


@pytest.mark.parametrize("per_range", [2_000, 7])
def test_edited_texts_follow_the_next_document(spark, monkeypatch, per_range):
    monkeypatch.setattr(fp, "ROWS_PER_RANGE", per_range)
    docs = edge_docs(spark)
    rows = [(r.doc_id, r.text or "", r.tie) for r in
            docs.withColumn("tie", F.xxhash64(F.coalesce("text", F.lit("")))).collect()]
    out = fp.edited_and_next(docs).collect()
    got = sorted(((r.doc_id, r.n_chars, hashlib.sha256(r.edited.encode()).hexdigest()) for r in out), key=str)
    assert got == sorted((x[:3] for x in brute(rows)), key=str)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    assert fp.edited_and_next(empty_docs(spark)).count() == 0


def test_sketches_keep_the_fraction_and_estimate(spark):
    a = " ".join(f"w{i}" for i in range(8000))
    b = " ".join(f"w{i}" for i in range(2000))
    rows = [(1, a), (2, b), (3, a), (4, None), (5, ""), (6, "one two"), (7, "one  two\n"), (8, "one three")]
    docs = fp.fingerprint(spark.createDataFrame(rows, "doc_id long, text string").withColumn("sketch", F.lit(1)))
    got = {r.doc_id: r.sketch for r in docs.collect()}
    assert got[1] == got[3] and got[4] == got[5] == [] and got[6] == got[7] != got[8] and len(got[6]) == 1
    assert abs(len(got[1]) / (len(words_of(a)) - 4) - fp.FRACTION) < 0.03
    assert got[1] == sorted(got[1])
    x, y = docs.where("doc_id = 1").select(F.col("sketch").alias("x")), docs.where("doc_id = 2").select(F.col("sketch").alias("y"))
    r = x.join(y).select(fp.likeness(F.col("x"), F.col("y")).alias("l"), fp.containment(F.col("y"), F.col("x")).alias("c"),
                         fp.merged(F.col("x"), F.col("y")).alias("m"), "x").first()
    assert abs(r.l - 0.25) < 0.05 and r.c == 1.0 and r.m == r.x


def test_no_python_in_the_plan(spark):
    plan = fp.edited_and_next(edge_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan
