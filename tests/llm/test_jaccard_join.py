import itertools
import random

import numpy as np
import pytest

from remitlens.llm import jaccard_join
from remitlens.llm.graph import components
from tests.llm.data import edge_docs, edge_rows, empty_docs, sentence, words_of


def shingles(text, k=5):
    w = words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows):
    """{(key, text): (n, smallest key reached)}; rows without shingles reach themselves."""
    docs = sorted({(k, t) for k, t in rows}, key=str)
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(docs)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            parent[top(i)] = top(j)
    out = {}
    for i, d in enumerate(docs):
        keys = [docs[j][0] for j in range(len(docs)) if sets[i] and top(j) == top(i) and docs[j][0] is not None]
        out[d] = (len(sets[i]), min(keys, default=None) if sets[i] else d[0])
    return out


def compare(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found, _ = jaccard_join.near_duplicates(docs)
    want = sorted(((k, *brute_of) for (k, t) in rows for brute_of in [brute(rows)[(k, t)]]), key=str)
    assert sorted(((r.id, r.n_shingles, r.component_id) for r in found.collect()), key=str) == want


def test_edge_rows(spark):
    compare(spark, [(k, t) for k, t, *_ in edge_rows(copies=3)])
    found, links = jaccard_join.near_duplicates(empty_docs(spark))
    assert found.count() == 0 and links.count() == 0


@pytest.mark.parametrize("group_rows", [2_000, 4])
def test_borderline_chains_and_passages(spark, monkeypatch, group_rows):
    """Chains of edits whose ends are unlike, several around the threshold, and
    a passage shared by unlike documents, so trees have work to do."""
    monkeypatch.setattr(jaccard_join, "GROUP_ROWS", group_rows)
    rng = random.Random(7)
    rows, key = [], 0
    passage = sentence(rng, 30)
    for _ in range(6):
        text = sentence(rng, 40).split()
        for _ in range(8):
            rows.append((key := key + 1, " ".join(text)))
            for _ in range(rng.choice([1, 1, 2, 3])):
                text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
    rows += [(key + 1 + i, passage + " " + sentence(rng, rng.randint(1, 60))) for i in range(25)]
    rng.shuffle(rows)
    compare(spark, rows)


def test_long_texts_around_the_threshold(spark):
    """Sets that send tokens, pairs of neighbours or both, in chains of edits."""
    rng = random.Random(11)
    rows, key = [], 0
    passage = sentence(rng, 60, 10**6)
    for size in (110, 130, 160, 170, 220, 400):
        text = sentence(rng, size, 10**6).split()
        for _ in range(7):
            rows.append((key := key + 1, " ".join(text)))
            for _ in range(rng.randint(1, max(2, size // 22))):
                text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
    rows += [(key + 1 + i, passage + " " + sentence(rng, rng.randint(90, 300), 10**6)) for i in range(10)]
    compare(spark, rows)


def test_number_of_pairs():
    assert jaccard_join.paired(75) == 80 and jaccard_join.paired(90) < 80 < jaccard_join.paired(50)


def test_tree_finds_every_pair_that_may_link():
    rng = np.random.default_rng(0)
    sets = [set(rng.integers(0, 4000, rng.integers(5, 120)).tolist()) for _ in range(60)]
    for s in list(sets):
        sets.append(set(list(s)[: int(len(s) * 0.9)]) | set(rng.integers(0, 4000, 3).tolist()))
    bits = np.zeros((len(sets), 1024), bool)
    for i, s in enumerate(sets):
        bits[i, [v % 1024 for v in s]] = True
    bits = np.packbits(bits, axis=1).view(np.uint64)
    n = np.array([len(s) for s in sets])
    order = np.argsort(n)
    tree = jaccard_join.SignatureTree(n[order], bits[order], np.arange(len(sets)))
    found = {frozenset((order[a], order[b])) for x, y, _ in tree.joined(tree, 75, chunk=300) for a, b in zip(x, y, strict=True)}
    linked = {frozenset((i, j)) for i, j in itertools.combinations(range(len(sets)), 2)
              if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert linked and linked <= found and len(found) < len(sets) ** 2 / 20


def test_one_of_each(spark):
    docs = edge_docs(spark, copies=3)
    out = jaccard_join.one_of_each(docs)
    assert out.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in out.collect()]
    want = brute([(k, t) for k, t, *_ in edge_rows(copies=3)])
    assert sorted(kept, key=str) == sorted(((k, t) for (k, t), (_, c) in want.items() if k == c), key=str)
    # a null key's row goes if a row with a key is linked with it, and stays else
    assert (None, None) in kept and sum(k is None for k, _ in kept) == 1


def test_components_of_long_paths_and_hubs(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5000)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    by = {}
    for r in got:
        by.setdefault(r.label, set()).add(r.node)
    assert sorted(map(len, by.values())) == [50, 61]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("paired", [32, 2])
def test_all_links_inside_components(spark, monkeypatch, paired):
    """Clusters of different texts that all link pairwise, copies among them: every
    link between classes and the number of linked rows, from pairs and from trees."""
    monkeypatch.setattr(jaccard_join, "PAIRED_ROWS", paired)
    monkeypatch.setattr(jaccard_join, "GROUP_ROWS", 7)
    rng = random.Random(5)
    rows = [(100, None), (101, "")]
    for size in (60, 200):
        text = sentence(rng, size, 10**6).split()
        for i in range(12):
            rows.append((len(rows), " ".join(text[:size - 1 - i // 2] + [f"e{i}"])))
        rows += [(len(rows) + i, rows[-1][1]) for i in range(3)]
    found, links = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    found, links = found.collect(), links.collect()
    sets = {k: shingles(t) for k, t in rows}
    near = lambda a, b: a and b and 100 * len(a & b) >= 75 * len(a | b)
    assert {r.id: r.n_links for r in found} == {
        k: sum(bool(near(s, o)) for i, o in sets.items() if i != k) for k, s in sets.items()}
    of = {r.id: r["class"] for r in found}
    want = {frozenset((of[i], of[j])) for i, j in itertools.combinations(sets, 2) if near(sets[i], sets[j])}
    want = {p for p in want if len(p) == 2}
    assert len(links) == len(want) >= 2 * 60 and {frozenset((r.a, r.b)) for r in links} == want
    compare(spark, rows)


def test_large_groups_of_near_copies_make_no_row_for_a_pair(spark, monkeypatch):
    """Near copies in groups beyond ``PAIRED_ROWS``: one row a class and group (with
    lists), and pairs that also meet in small groups are counted once."""
    made = []
    stored = jaccard_join._stored
    monkeypatch.setattr(jaccard_join, "_stored", lambda rows, name: made.append((name, out := stored(rows, name))) or out)
    monkeypatch.setattr(jaccard_join, "PAIRED_ROWS", 10)
    rng = random.Random(2)
    text = sentence(rng, 150, 10**6).split()
    rows = []
    for i in range(40):
        own = list(text)
        own[7 * (i % 20)] = f"e{i % 20}"  # pairs i, i + 20 have an edit in common
        own[149 - i % 9] = f"f{i}"
        rows.append((i, " ".join(own)))
    rows.append((40, rows[0][1]))
    found, links = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))
    groups = {name: df for name, df in made}
    classes = groups["classes"].count()
    near = groups["near"]
    assert near.columns == ["token", "i", "j", "class", "others"]
    assert near.groupBy("token", "i", "j").count().where(f"count > {classes}").isEmpty()
    sets = {k: shingles(t) for k, t in rows}
    linked = lambda a, b: 100 * len(a & b) >= 75 * len(a | b)
    assert {r.id: r.n_links for r in found.collect()} == {
        k: sum(linked(s, o) for i, o in sets.items() if i != k) for k, s in sets.items()}
    links = [(r.a, r.b) for r in links.collect()]
    assert len(links) == len(set(links)) and all(a < b for a, b in links)
    assert groups["lists"].count() < len(links)
    compare(spark, rows)


@pytest.mark.parametrize("all_links", [True, False])
def test_keys_are_dealt_by_token_once(spark, all_links):
    """Of all keys that classes send, those that meet are found in one shuffle, without a join."""
    classes = spark.createDataFrame([(1, 9, [5, 6, 7]), (2, 8, [6, 8]), (3, 7, [8, 6]), (4, 3, [1])],
                                    "class long, n long, tokens array<long>")
    met = jaccard_join._met(classes, all_links)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    got = sorted(tuple(r) for r in met.collect())
    assert got == ([(1, 9, 6, 3), (2, 8, 6, 3), (2, 8, 8, 2), (3, 7, 6, 3), (3, 7, 8, 2)] if all_links
                   else [(0, 2, 6, 1), (0, 3, 8, 2), (1, 1, 6, 1), (1, 2, 8, 2), (1, 3, 6, 1)])


def test_neighbours_of_small_sets_only_are_left_out(spark):
    """Near copies small enough for single tokens meet by these (even keys); pairs of
    neighbours (odd keys) count only where a larger set sends them too."""
    classes = spark.createDataFrame([(1, 140, [4, 5, 7]), (2, 150, [4, 5, 7]), (3, 170, [7])],
                                    "class long, n long, tokens array<long>")
    for all_links in (True, False):
        met = jaccard_join._met(classes, all_links, 75).select("class", "token").collect()
        assert sorted(map(tuple, met)) == [(1, 4), (1, 7), (2, 4), (2, 7), (3, 7)]
    rng = random.Random(3)
    text = sentence(rng, 150, 10**6).split()
    grams, ends = jaccard_join.shingle_sets(jaccard_join.pa.array([" ".join(text)]), 5)
    keys, _ = jaccard_join.sent_keys(grams, ends, 75)
    assert (keys % 2).sum() == jaccard_join.paired(75) and (keys % 2 == 0).sum() == 146 - 110 + 1


def test_long_rows_of_other_classes_are_dropped_before_they_are_dealt(spark):
    """Only rows whose bit is set are dealt by class; classes of equal bits are told apart."""
    span = jaccard_join.SKETCH_PARTS * jaccard_join.SKETCH_BITS
    rows = [(c, f"t{c}") for c in (5, 5, 5 + span, -7, -7 - span, 6, 32_767, 32_768, -2**63, 2**63 - 1, 0)]
    docs = spark.createDataFrame(rows, "class long, packed string")
    for needed in ([5, -7, 32_768, 2**63 - 1], [0, -2**63, 32_767], []):
        some = jaccard_join._some(docs, spark.createDataFrame([(c,) for c in needed], "class long"))
        assert sorted(map(tuple, some.collect())) == sorted(r for r in rows if r[0] in needed)
        plan = some._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("[class", plan.index("Join")) < plan.index("getbit") < plan.index("__part", plan.index("getbit"))


@pytest.mark.parametrize("parts", [1, 2])
def test_blocks_meet_once(parts):
    """Each pair of rows of fitting sizes of a task lies in one pair of blocks."""
    pa = jaccard_join.pa
    rng = random.Random(parts)
    n = [rng.choice([20, 25, 40, 60, 61, 200]) for _ in range(40)]
    rows = pa.table({"token": [9] * 40, "class": list(range(40)), "n": n, "side": pa.array([c % parts for c in range(40)], pa.int32()),
                     "i": pa.array([0] * 40, pa.int32()), "j": pa.array([parts - 1] * 40, pa.int32())})
    met, places = [], set()
    for token, i, j, group in jaccard_join._blocks(rows, 6, 75):
        assert token == 9 and (i, j) not in places and len(group) <= 12
        places.add((i, j))
        own = list(zip(group["class"].to_pylist(), group["side"].to_pylist(), strict=True))
        met += [(min(a, b), max(a, b)) for (a, x), (b, y) in itertools.combinations(own, 2)
                if x != y or group["i"][0].as_py() == group["j"][0].as_py()]
    fits = [(a, b) for a, b in itertools.combinations(range(40), 2)
            if (parts == 1 or a % 2 != b % 2) and 100 * min(n[a], n[b]) >= 75 * max(n[a], n[b])]
    assert len(met) == len(set(met)) and set(fits) <= set(met)


def exchanges_of(spark, build):
    """How many exchanges the jobs of ``build`` have (each holds a thread of the driver for a minute)."""
    before = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getThreadMXBean
    names = lambda: {i.getThreadId(): i.getThreadName() for i in before().getThreadInfo(before().getAllThreadIds()) if i}
    was = names()
    build()
    return sum("shuffle-exchange" in v or "broadcast-exchange" in v for k, v in names().items() if k not in was)


@pytest.mark.parametrize("last", [200_000, 40, 0])
def test_few_links_are_contracted_in_one_task(spark, monkeypatch, last):
    """Components are the same however many links one task contracts; a small table costs
    a few exchanges, however many rounds it would need."""
    from remitlens.llm import graph
    monkeypatch.setattr(graph, "LAST_ROWS", last)
    rng = random.Random(5)
    path = [(i, i + 1) for i in range(60)]
    rows = path + [(100 + rng.randrange(30), 100 + rng.randrange(30)) for _ in range(25)] + [(500, 500), (-2**63, 2**63 - 1)]
    rng.shuffle(rows)
    links = spark.createDataFrame(rows, "a long, b long")
    made = []
    used = exchanges_of(spark, lambda: made.extend(components(links).collect()))
    want = {x: x for pair in rows if pair[0] != pair[1] for x in pair}
    for _ in want:
        for a, b in rows:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    got = {r.node: r.label for r in made}
    assert len(made) == len(got) and set(got) == set(want)
    assert len({(got[x], want[x]) for x in want}) == len(set(got.values())) == len(set(want.values()))
    if last > 1_000:
        assert used <= 3
    assert components(links.where("a = b")).count() == 0
