from collections import Counter

from remitlens.llm.line_dedup import LineRuns, drop_common_lines
from remitlens.session import scratch_since
from tests.llm.data import edge_docs, edge_rows, empty_docs

STRIP = " \t\n\x0b\x0c\r"


def fold(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(STRIP))


def brute(rows, min_docs):
    docs = {(k, t) for k, t, *_ in rows}
    held = Counter(key for k, t in docs for key in {fold(x) for x in (t or "").split("\n")} if key)
    out = []
    for k, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (fold(x) and held[fold(x)] >= min_docs)]
        out.append((k, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, str(r)))


def test_matches_brute_force_on_edge_rows(spark):
    for min_docs in (2, 7, 12, 100):
        out = drop_common_lines(edge_docs(spark), min_docs=min_docs)
        got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()]
        assert order(got) == order(brute(edge_rows(), min_docs))


def test_other_columns_stay_and_empty_table(spark):
    out = drop_common_lines(edge_docs(spark), min_docs=3)
    assert out.select("id", "h1", "label", "n").distinct().collect() == [(-1, "h", 5, 7)]
    assert drop_common_lines(empty_docs(spark)).count() == 0


def test_runs_compact_and_prove(spark):
    runs = LineRuns(spark, min_docs=3, fanout=2)
    for b in range(5):
        rows = [(b, 0, k, k) for k in range(b + 1)] * 2  # a repeat inside a document counts once
        runs.add(spark.createDataFrame(rows, "id long, at long, h1 long, h2 long"))
    assert {r.h1 for r in runs.common().collect()} == {0, 1, 2}
    assert all(len(level) < 2 for level in runs.levels) and len(runs.levels) >= 2


def test_lines_are_stored_in_one_file_a_task(spark):
    """The batches share a file of each task, and each is read back from it whole."""
    rows = [(i, f"common\nown {i}\nshared {i % 4}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    mark = scratch_since()[1]
    out = {r.doc_id: r.text for r in drop_common_lines(docs, min_docs=10).collect()}
    assert out == {i: f"own {i}" for i, _ in rows}
    path, = (p for p in scratch_since(mark)[0] if "/lines-" in p)
    files = spark.read.parquet(path).inputFiles()
    assert 1 <= len(files) <= 3
    assert spark.read.parquet(path).select("batch").distinct().count() == 4
