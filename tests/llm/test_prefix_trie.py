import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from remitlens.llm import prefix_trie as pt
from remitlens.llm.catalog import ORACLES
from tests.llm.data import words_of

SCHEMA = "conv_id long, turn long, role string, text string, pos int, digest string, n long"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: [said for _, said in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - int(np.fmod(c, 20))
        paths[c] = tuple(own.get(donor, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    out = []
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)

    def subtree(node):
        stack = [node]
        while stack:
            at = stack.pop()
            yield at
            stack += kids[at]

    for node, convs in members.items():
        under = list(subtree(node))
        ends = sorted(c for c in convs if len(paths[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids[node]),
                    sum(not kids[u] for u in under),
                    sum((len(members[u]) - 1) * len(words_of(u[-1][1])) for u in under if u),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(seed, n=120, said=5, longest=6):
    """Few different turns, so prefixes and whole conversations repeat; gaps in the
    ids, null turns, roles and texts, equal turns, repeated rows, one id below 0."""
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(3 * n), n) + [-7, -20, None]:
        for turn in range(rng.randrange(1, longest)):
            text = rng.choice([None, "", "one two", "a\tb c ", "é"] + [f"text {i}" for i in range(said)])
            rows.append((conv, rng.choice([turn, turn, turn, None, 2]), rng.choice(["user", "bot", None]), text, 9, "x", 1))
    rows += rng.sample(rows, 5)
    rng.shuffle(rows)
    return rows


def nodes(spark, rows, **kw):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted((tuple(r) for r in pt.prefix_trie(frame, **kw).select(*pt.COLUMNS).collect()), key=str)


@pytest.mark.parametrize("seed,cells", [(1, None), (2, 4), (3, 64)])
def test_equals_the_definition(spark, seed, cells):
    rows = rows_of(seed)
    assert nodes(spark, rows, cells=cells) == brute(rows)


def test_copies_long_conversations_and_short_pieces(spark, monkeypatch):
    monkeypatch.setattr(pt, "IDS_PER_PIECE", 7)
    monkeypatch.setattr(pt, "STRIP", 16)
    rows = [(c, t, "user", f"t{t} x y", 0, "", 0) for c in range(0, 4000, 20) for t in range(3)]  # 200 equal ones
    rows += [(7, t, "user", f"t{t} x y", 0, "", 0) for t in range(300)] + [(11, None, None, None, 0, "", 0)]
    got = nodes(spark, rows, cells=32)
    assert got == brute(rows) and max(r[1] for r in got) > 250


def test_empty_table(spark):
    assert nodes(spark, []) == [] and nodes(spark, [(None, 1, "a", "b", 0, "", 0)]) == []


def test_turnless_conversations_make_a_root_alone(spark):
    conv = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 1)  # borrows two turns of an absent donor
    rows = [(conv, 1, "user", "gone", 0, "", 0)]
    ends = hashlib.sha256(str(conv).encode()).hexdigest()
    assert nodes(spark, rows) == brute(rows) == [(conv, 0, None, 1, 0, 1, 0, ends)]


def test_sketch_never_counts_too_few(spark):
    digests = [hashlib.blake2b(str(i % 300).encode(), digest_size=16).digest() for i in range(400)]
    chain = spark.createDataFrame([(1, 1, d) for d in digests], "conv long, depth long, digest binary").repartition(5)
    for cells in (64, 1 << 12):
        sketch = [pt._unpack(s) for s in pt.count_min(chain, cells)]
        at = pt._cells(pa.array(digests, pa.binary()), cells)
        least = np.min([row[c] for row, c in zip(sketch, at, strict=True)], axis=0)
        assert all(least[i] == 2 for i, d in enumerate(digests) if digests.count(d) > 1)
        assert least.min() >= 1
    assert (least == 1).sum() > 190  # the wide sketch proves nearly all of the 200 single ones


def test_sql_equals_the_definition(spark, tmp_path):
    rows = rows_of(5)
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    rel = con.sql(ORACLES["op12_prefix_trie"]).project(", ".join(pt.COLUMNS))
    assert sorted(rel.fetchall(), key=str) == brute(rows)


def test_texts_are_not_shuffled(spark):
    frame = spark.createDataFrame(rows_of(4), SCHEMA)
    plan = pt._turns(frame)._jdf.queryExecution().toString()
    assert "Exchange" not in plan
    assert set(pt.rebuilt(frame).columns) == {"conv", "pos", "said", "w"}
