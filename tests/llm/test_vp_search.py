import numpy as np
import pytest
from pyspark.sql import functions as F

from remitlens.llm import vp_search
from remitlens.llm.vp_search import nearest


def vectors(n=700, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x[: n // 3] = x[0]  # a vector that a third of the rows share
    x[n // 3: n // 2] *= 3
    return x


def brute(ids, x, k):
    x = x.astype(np.float64)
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        score = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def frame(spark, ids, x, more=()):
    rows = [(int(i), [float(c) for c in v], "l", 1.0) for i, v in zip(ids, x, strict=True)]
    return spark.createDataFrame([*rows, *more], "vec_id long, embedding array<float>, id string, score double")


@pytest.mark.parametrize("shard_rows", [64, 4096])
def test_factor_one_is_exact(spark, shard_rows):
    x = vectors()
    ids = np.random.default_rng(1).permutation(len(x)) + 1
    odd = [(100_001, None, "a", 0.0), (100_020, [], "a", 0.0), (100_040, [0.0] * 16, "a", 0.0), (None, [1.0] * 16, "a", 0.0),
           (100_060, [float("nan")] + [1.0] * 15, "a", 0.0), (100_080, [None] + [1.0] * 15, "a", 0.0),
           (100_100, [float("inf")] * 16, "a", 0.0), (100_120, [1.0, 2.0], "a", 0.0)]
    odd.append((int(ids[5]), [float(c) for c in x[5]], "a", 0.0))  # a repeated row
    all_ = frame(spark, ids, x, odd)
    out = nearest(all_, all_.where(F.col("vec_id") % 20 == 0), k=20, shard_rows=shard_rows, block_queries=16).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute(ids, x, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


def test_recall_of_the_production_factor(spark):
    x = np.random.default_rng(3).normal(size=(4000, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = np.arange(len(x))
    all_ = frame(spark, ids, x)
    out = nearest(all_, all_.where(F.col("vec_id") % 20 == 0), k=20, factor=0.2, shard_rows=2000).collect()
    want = {(q, i) for q, found in brute(ids, x, 20).items() for i, _ in found}
    assert len(want & {(r.query_id, r.vec_id) for r in out}) >= 0.9 * len(want)


def test_few_candidates_and_empty(spark):
    few = frame(spark, np.array([20, 21, 22]), np.eye(3, dtype=np.float32) + 1)
    assert nearest(few, few.where("vec_id = 20"), k=20).count() == 2
    one = few.where("vec_id = 20")
    assert nearest(one, one).count() == 0
    assert nearest(few.limit(0), few.limit(0)).count() == 0
    assert nearest(few, few.limit(0)).count() == 0


@pytest.mark.parametrize("norms", ["one of 2", "lognormal", "small queries"])
def test_recall_of_the_production_factor_on_unequal_norms(spark, norms):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if norms == "one of 2":
        x[7] *= 2
    elif norms == "lognormal":
        x *= rng.lognormal(0, 0.5, len(x))[:, None]
    else:
        x[::20] *= 0.01
    x, ids = x.astype(np.float32), np.arange(len(x))
    all_ = frame(spark, ids, x)
    out = nearest(all_, all_.where(F.col("vec_id") % 20 == 0), k=20, factor=0.2, shard_rows=4000).collect()
    want = {(q, i) for q, found in brute(ids, x, 20).items() for i, _ in found}
    assert len(want & {(r.query_id, r.vec_id) for r in out}) >= 0.9 * len(want)


@pytest.mark.parametrize("places", [1 << 19, 50])
def test_ties_of_many_different_vectors(monkeypatch, places):
    """Products of 0 and 1 by the hundred: the smaller ids win."""
    monkeypatch.setattr(vp_search, "MOST_PLACES", places)
    monkeypatch.setattr(vp_search, "LEAF", 32)
    rng = np.random.default_rng(6)
    x = np.unique((rng.random((900, 24)) < 0.1) * 1.0, axis=0)
    x = rng.permutation(x[x.any(axis=1)])
    ids = rng.permutation(len(x)) * 20
    q, i, s = vp_search.search_shard(x, [ids[j:j + 1] for j in range(len(x))], x, ids, 20, 1.0)
    got = {int(a): [(int(b), float(c)) for b, c in zip(i[q == a], s[q == a], strict=True)] for a in ids}
    assert got == brute(ids, x, 20)
