import hashlib
import random
import re

import duckdb
import pytest

from remitlens.llm import private_data as pd
from remitlens.llm.catalog import ORACLES, QUERIES
from tests.llm.data import edge_docs, edge_rows, empty_docs

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in twice) % 10 == 0


def good(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "")
            if good(k, m.group())]


def fuzz(seed, n=400):
    """Texts of the letters and pieces that make matches begin, end, touch and fail."""
    rng = random.Random(seed)
    bits = ["@", ".", "-", " ", "  ", "+", "(", ")", "_", "%", "a", "b.c", "é", "😀", "1", "12", "255", "256", "007", "\n",
            "4041894974608795", "4041-8949 7460 8795", "a@b.c", "x@y", "1.2.3.4", "+1 (988) 555-2485", "0" * 14, "99999"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 30))) for _ in range(n)]


def test_base_spans_equal_the_definition(spark):
    texts = fuzz(1) + [r[1] for r in edge_rows()] + ["a" * 3000, "1" * 3000, "a@" * 3000, "1.2." * 20_000,
                                                    "+1" + "(" * 3000, "a@b" + ".c" * 100_000, "12 " * 50_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = {r.doc_id: [tuple(s)[:3] for s in r.base_spans] for r in pd.find_private(docs).collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute(t), (i, (t or "")[:80])


def test_long_texts_take_time_in_proportion(spark):
    # each would take hours if a pattern went back to every letter
    texts = ["a" * 3_000_000, "1" * 3_000_000, "a@" * 1_000_000, "+1" + "(" * 3_000_000, "1.1." * 100_000]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [len(r.base_spans) for r in pd.find_private(docs).collect()] == [0, 0, 0, 0, 50_000]


MORE = [
    ("iban GB82 WEST 1234 5698 7654 32.", ["iban:5:32"]), ("GB82WEST12345698765432", ["iban:0:22"]),
    ("iban GB82 WEST 1234 5698 7654 33", []), ("xGB82WEST12345698765432", []), ("GB82WEST12345698765432x", []),
    ("his SSN: 123-45-6789", ["ssn:9:20"]), ("123-45-6789", []), ("ssn 000-45-6789", []), ("ssn 1123-45-6789", []),
    ("call (988) 555-2485 now", ["local:5:19"]), ("(988) 555-2485", []), ("recall 988 555-2485", []),
    ("phone +1 (988) 555-2485", ["phone:6:23"]), ("tel 988.555.2485", ["local:4:16"]),
]


@pytest.mark.parametrize("text,spans", MORE)
def test_checks_and_context_decide_the_other_kinds(spark, text, spans):
    row = spark.createDataFrame([(text,)], "text string")
    found = pd.find_private(row).select(pd.as_text(pd.F.col("spans"))).first()[0]
    assert found == ",".join(spans)


def test_context_raises_the_score(spark):
    rows = spark.createDataFrame([("mail a@b.c",), ("to a@b.c",), ("mail " + "x" * 50 + " a@b.c",)], "text string")
    assert [r.spans[0].score for r in pd.find_private(rows).collect()] == [1.0, 0.8, 0.8]


def test_query_equals_its_sql(spark, tmp_path):
    texts = fuzz(2) + [t for t, _ in MORE] + [None, ""]
    path = str(tmp_path)
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/documents.parquet/*.parquet')")
    rel = con.sql(ORACLES["op13_private_data"])
    got = QUERIES["op13_private_data"](spark, path).select(*rel.columns).collect()
    assert sorted(map(tuple, got)) == sorted(rel.fetchall())
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r.n_email, r.base_sha256, r.spans) for r in got if r.doc_id == len(texts) - 2] == [(0, empty, "")]


def test_awkward_tables(spark):
    docs = edge_docs(spark).selectExpr("*", "1 AS spans", "2 AS base_spans")
    out = pd.find_private(docs)
    assert out.count() == docs.count() and set(out.columns) == set(docs.columns)
    assert pd.find_private(empty_docs(spark)).count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hash" not in plan
