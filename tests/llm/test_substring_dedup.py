import hashlib

import pytest

from remitlens.llm import substring_dedup
from tests.llm.data import edge_docs, edge_rows, empty_docs, words_of


def brute(rows, size):
    first = {}
    for k, t, *_ in rows:
        w = words_of(t)
        for i in range(len(w) - size + 1):
            run = tuple(w[i:i + size])
            first[run] = min(first.get(run, float("inf")), float("inf") if k is None else k)
    out = []
    for k, t, *_ in rows:
        w = words_of(t)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i:i + size])] < (float("inf") if k is None else k):
                gone[i:i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((k, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept if any(gone) else t))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, str(r)))


@pytest.mark.parametrize(("size", "block"), [(13, 4 << 20), (13, 1500), (5, 1500), (3, 4 << 20)])
def test_matches_brute_force_on_edge_rows(spark, monkeypatch, size, block):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", block)
    out = substring_dedup.remove_repeats(edge_docs(spark), min_words=size, digest=True)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.text) for r in out.collect()]
    assert order(got) == order(brute(edge_rows(), size))
    assert out.select("id", "h1", "label", "n").distinct().collect() == [(-1, "h", 5, 7)]


def test_empty_table(spark):
    assert substring_dedup.remove_repeats(empty_docs(spark)).collect() == []
