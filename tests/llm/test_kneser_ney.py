import math
import random
from collections import Counter, defaultdict

import pytest

from remitlens.llm import kneser_ney as kn
from tests.llm.data import edge_docs, empty_docs


def brute_log_probability(train, text):
    """The model's definition, straight from count dictionaries."""
    grams = lambda t: [(b"\0" * (kn.ORDER - 1) + t)[i:i + kn.ORDER] for i in range(len(t))]
    counts = {kn.ORDER: Counter(g for t in train for g in grams(t))}
    for m in range(kn.ORDER - 1, 0, -1):
        counts[m] = Counter(g[1:] for g in counts[m + 1])
    cuts, stats = {}, {}
    for m, c in counts.items():
        n = Counter(c.values())
        if n[1] and n[2]:
            y = n[1] / (n[1] + 2 * n[2])
            cuts[m] = [min(max(k - (k + 1) * y * n[k + 1] / n[k] if n[k] else k / 2, 0.05), k - 0.05) for k in (1, 2, 3)]
        else:
            cuts[m] = [0.5, 0.75, 0.9]
        stats[m] = defaultdict(lambda: [0, 0.0])
        for g, k in c.items():
            stats[m][g[:-1]][0] += k
            stats[m][g[:-1]][1] += cuts[m][min(k, 3) - 1]

    def p(gram):
        m = len(gram)
        below = p(gram[1:]) if m > 1 else 1 / 256
        if gram[:-1] not in stats[m]:
            return below
        total, off = stats[m][gram[:-1]]
        k = counts[m].get(gram, 0)
        return ((k - cuts[m][min(k, 3) - 1] if k else 0) + off * below) / total

    return sum(math.log(p(g)) for g in grams(text))


def corpus(n=120, seed=0):
    rng = random.Random(seed)
    letters = "etaoin shrdlu etaoin"
    docs = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(20, 200))) + "é", "en", "x") for i in range(n)]
    docs += [(n + i, "%%#!Q" * rng.randint(10, 30), "en", "x") for i in range(10)]
    return docs, [(i, int(i < n), 0) for i in range(0, n + 10, 2)]


@pytest.mark.parametrize("block", [4 << 20, 700])
def test_matches_the_definition(spark, monkeypatch, block):
    monkeypatch.setattr(kn, "BLOCK_BYTES", block)
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, key string").repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    train = {r.doc_id for r in kn.trusted_keys(lab, "doc_id", "quality", kn.MOST_TRUSTED).where("train").collect()}
    assert 30 < len(train) < 60
    out = {r.doc_id: r for r in kn.perplexities(d, lab).collect()}
    assert len(out) == len(docs)
    text = [t.encode() for i, t, *_ in docs if i in train]
    for i, t, *_ in docs[::9] + docs[-3:]:
        want = brute_log_probability(text, t.encode())
        assert math.isclose(out[i].log_prob, want, rel_tol=1e-4)
        assert math.isclose(out[i].perplexity, math.exp(-want / len(t.encode())), rel_tol=1e-3)
    assert sum(out[i].keep for i in range(120)) >= 117 and not any(out[120 + i].keep for i in range(10))


def test_edge_rows(spark):
    labels = spark.createDataFrame([(8, 1, 0), (8, 0, 0), (None, 1, 0), (61, 1, 0), (62, None, 0), (63, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    docs = edge_docs(spark)
    for some in (labels, labels.limit(0)):
        out = kn.perplexities(docs, some).collect()
        assert len(out) == docs.count()
        for r in out:
            assert (r.perplexity is None) == (r.n_bytes == 0)
            assert r.keep or r.n_bytes
    flat = [r for r in kn.perplexities(docs, labels.limit(0)).collect() if r.n_bytes]
    assert all(math.isclose(r.perplexity, 256, rel_tol=1e-5) and r.keep for r in flat)
    assert kn.perplexities(empty_docs(spark), labels).count() == 0


def test_rare_grams_are_neither_flattened_nor_rounded(spark):
    """The order is 5, and a byte rarer than e^-16 keeps its own log-probability."""
    docs = [(i, "a" * 40_000, "en", "x") for i in range(40)] + [(40, "aaaaaaaaaQ", "en", "x"), (41, "abcde", "en", "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, key string")
    lab = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    train = {r.doc_id for r in kn.trusted_keys(lab, "doc_id", "quality", kn.MOST_TRUSTED).where("train").collect()}
    text = [b"a" * 40_000 for _ in train]
    out = {r.doc_id: r for r in kn.perplexities(d, lab).collect()}
    assert kn.ORDER == 5
    assert brute_log_probability(text, b"aaaaaaaaaQ") - brute_log_probability(text, b"aaaaaaaaa") < -16.5
    for i in (40, 41):
        assert math.isclose(out[i].log_prob, brute_log_probability(text, docs[i][1].encode()), rel_tol=1e-6)


def test_thresholds_cover_all_trusted_documents(spark):
    """Training reads few texts; a rare language's limit comes from all of its
    other trusted documents."""
    rng = random.Random(3)
    text = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(20, 60)))
    docs = [(i, text("etaoin "), "en") for i in range(160)] + [(160 + i, text("qxzjkvw#"), "xx") for i in range(40)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    lab = spark.createDataFrame([(i, 1, 0) for i, *_ in docs], "doc_id long, quality int, toxic int")
    train = {r.doc_id for r in kn.trusted_keys(lab, "doc_id", "quality", 12).where("train").collect()}
    out = kn.perplexities(d, lab, most_trusted=12).collect()
    for lang in ("en", "xx"):
        x = sorted(r.perplexity for r in out if r.lang == lang and r.doc_id not in train)
        at = kn.QUANTILE * (len(x) - 1)
        low = int(at)
        want = kn.SLACK * (x[low] + (at - low) * (x[min(low + 1, len(x) - 1)] - x[low]))
        assert len(x) >= kn.LEAST_SEEN
        assert all(math.isclose(r.threshold, want, rel_tol=1e-9) for r in out if r.lang == lang)


def test_quantiles(spark):
    rng = random.Random(1)
    rows = [(of, x) for of in ("a", "b", None) for x in [rng.uniform(1, 300) for _ in range(rng.randint(1, 90))] + [7.0] * 9]
    values = spark.createDataFrame([*rows, ("c", 5.0)], "of string, x double")
    for q in (0.0, 0.3, 0.99, 1.0):
        want = {r.of: (r.q, r.n) for r in values.groupBy("of").agg(
            kn.F.percentile("x", q).alias("q"), kn.F.count("x").alias("n")).collect()}
        got = {r.of: (r.q, r.n) for r in kn.quantiles(values, q).collect()}
        assert got.keys() == want.keys()
        assert all(math.isclose(got[o][0], want[o][0], rel_tol=1e-12) and got[o][1] == want[o][1] for o in want)


def test_training_reads_all_trusted_documents(spark, monkeypatch):
    """Without a limit three quarters of all trusted keys train, and each block learns
    which of its rows do, repeated and null keys among them."""
    assert kn.MOST_TRUSTED is None
    lab = spark.range(60_000).selectExpr("id AS doc_id", "1 AS quality")
    assert 44_000 < kn.trusted_keys(lab, "doc_id", "quality", kn.MOST_TRUSTED).where("train").count() < 46_000
    monkeypatch.setattr(kn, "BLOCK_BYTES", 900)
    docs, labels = corpus(60, seed=4)
    docs += [(None, "zzzz", "en", "x"), docs[0], docs[2], docs[2]]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, key string").repartition(3)
    lab = spark.createDataFrame([*labels, (None, 1, 0)], "doc_id long, quality int, toxic int")
    train = {r.doc_id for r in kn.trusted_keys(lab, "doc_id", "quality").where("train").collect()}
    text = [t.encode() for i, t, *_ in docs if i in train]
    out = kn.perplexities(d, lab).collect()
    assert len(out) == len(docs)
    got = {(r.doc_id, r.n_bytes): r.log_prob for r in out}
    for i, t, *_ in docs[::7] + docs[-4:]:
        assert math.isclose(got[i, len(t.encode())], brute_log_probability(text, t.encode()), rel_tol=1e-4)


def test_places_of_long_texts(monkeypatch):
    grams = kn.np.random.default_rng(0).integers(0, 1 << 40, 3_000, dtype=kn.np.uint64) // kn.np.uint64(1 << 30)
    want = kn.np.unique(grams, return_inverse=True)
    for bits in (24, 4):
        monkeypatch.setattr(kn, "PLACE_BITS", bits)
        assert all((a == b).all() for a, b in zip(kn._with_places(grams), want, strict=True))
