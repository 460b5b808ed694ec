import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from remitlens.llm import fill_in_middle as fim
from tests.llm.data import edge_docs, edge_rows, empty_docs


def brute(key, text, percent=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return key, n, "plain", None, None, text
    if h[3] % 100 < spm:
        return key, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return key, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


ODD = [(100, "\n"), (101, "\n\n\né\n"), (102, "a<P>b\nc"), (103, "<S\n>\n<M\n<P"), (104, "\n" * 70_000 + "x"),
       (105, "é\n" * 50_000), (106, "line of text 😀\r\n" * 20_000), (107, "no line end"), (108, "<\n<\n<\n")]


@pytest.mark.parametrize("percent,spm,slice_bytes", [(100, 50, 2 << 20), (60, 100, 500), (0, 50, 2 << 20)])
def test_equals_the_definition(spark, monkeypatch, percent, spm, slice_bytes):
    monkeypatch.setattr(fim, "SLICE_BYTES", slice_bytes)
    rows = [(r[0], r[1]) for r in edge_rows()] + ODD
    docs = edge_docs(spark).select("doc_id", "text", F.lit(1).alias("n"), F.lit("x").alias("output")).unionByName(
        spark.createDataFrame([(*r, 1, "x") for r in ODD], "doc_id long, text string, n int, output string"))
    out = fim.fill_in_middle(docs, percent=percent, spm_percent=spm)
    got = out.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted((brute(k, t, percent, spm) for k, t in rows), key=str)
    assert sorted((str(r.doc_id), r.back) for r in got) == sorted((str(k), t or "") for k, t in rows)


def test_empty_table(spark):
    assert fim.fill_in_middle(empty_docs(spark)).count() == 0


def test_every_kind_of_container_selects(spark):
    rng = np.random.default_rng(0)
    parts = [np.sort(rng.choice(1 << 16, 300, replace=False)),                       # array
             (1 << 16) + np.sort(rng.choice(1 << 16, 30_000, replace=False)),       # bitmap
             (3 << 16) + np.concatenate([np.arange(100, 9000), np.arange(9100, 65_536)]),  # runs
             (4 << 16) + np.arange(5)]
    places = np.concatenate(parts).astype(np.int64)
    s = fim.BoundarySet(places)
    assert [type(c).__name__ for c in s.containers] == ["_Array", "_Bitmap", "_Runs", "_Runs"]
    k = rng.permutation(len(places))
    assert (s.select(k) == places[k]).all()


@pytest.mark.parametrize("marks", [("<P>", "<P>x", "<M>"), ("aa", "b", "c"), ("", "b", "c"), ("xy", "yz", "c")])
def test_marks_that_overlap_are_refused(spark, marks):
    with pytest.raises(ValueError):
        fim.fill_in_middle(empty_docs(spark), marks=marks)
