"""The fact store as a catalog table: slices listed, cleared and rewritten by themselves."""

from __future__ import annotations

import pytest

from remitlens.session import scratch_path
from remitlens.sources import fact_store, fact_table

SCHEMA = "transaction_id string, amount double, province string, district string, year int, quarter string"
ROWS = [("1", 1.0, "A", "d", 2024, "Q1"), ("2", 2.0, "A", "d", 2024, "Q1"), ("3", 3.0, "A", "e/f=100% o'k+", 2024, "Q1"),
        ("4", 4.0, "B", None, 2023, "Q4"), ("5", 5.0, " ", "d", 2023, "Q2"), ("6", None, "Bắc\\Ninh", "d", 2024, "Q1")]


@pytest.fixture
def table(spark):
    return fact_table.create(spark.createDataFrame(ROWS, SCHEMA), fact_table.fresh_name(spark, "t"))


def _rows(spark, name):
    return sorted(tuple(r) for r in spark.table(name).select("transaction_id", "province", "district", "year", "quarter").collect())


def _files(spark, name):
    """File → time of its last change, of all data files."""
    seen = spark.table(name).select("_metadata.file_path", "_metadata.file_modification_time").distinct().collect()
    return {r[0]: r[1] for r in seen}


SAFE = sorted((i, "Unknown" if p is None or not p.strip() else p, d or "Unknown", y, q) for i, _, p, d, y, q in ROWS)


def test_listing_opens_no_data_file(spark, table):
    listed = fact_table.list_partitions(spark, table)
    assert sorted(tuple(r) for r in listed.collect()) == sorted({r[1:] for r in SAFE})
    assert "FileScan" not in listed._jdf.queryExecution().toString()
    for province, district, year, quarter in {r[1:] for r in SAFE}:
        assert fact_table.partition_exists(spark, table, province, district, year, quarter).first()[0]
    assert not fact_table.partition_exists(spark, table, "A", "d", 2024, "Q2").first()[0]


def test_clearing_a_slice_touches_no_other_file(spark, table):
    before = _files(spark, table)
    for _ in range(2):  # a slice that is not there any more is no error
        fact_table.delete_partition(spark, table, "A", "e/f=100% o'k+", 2024, "Q1")
    assert _rows(spark, table) == [r for r in SAFE if r[0] != "3"]
    after = _files(spark, table)
    assert len(after) == len(before) - 1 and all(before[f] == t for f, t in after.items())
    assert ("A", "e/f=100% o'k+", 2024, "Q1") not in {tuple(r) for r in fact_table.list_partitions(spark, table).collect()}


def test_rewriting_slices(spark, table):
    before = _files(spark, table)
    new = spark.createDataFrame([("7", 7.0, "A", "d", 2024, "Q1"), ("8", 8.0, "C", "d", 2024, "Q1")], SCHEMA)
    gone = spark.createDataFrame(ROWS, SCHEMA).where("province = 'A'")
    fact_table.replace_partitions(new, table, gone=gone)
    kept = [r for r in SAFE if r[1] != "A"]
    assert _rows(spark, table) == sorted(kept + [("7", "A", "d", 2024, "Q1"), ("8", "C", "d", 2024, "Q1")])
    assert sum(t == before.get(f) for f, t in _files(spark, table).items()) == 3
    fact_table.replace_partition(new.where("transaction_id = '0'"), table, "C", "d", 2024, "Q1")  # no rows: cleared
    fact_table.replace_partition(new, table, "A", "d", 2024, "Q1")
    assert _rows(spark, table) == sorted(kept + [("7", "A", "d", 2024, "Q1")])
    fact_table.append(new, table)
    assert _rows(spark, table) == sorted(kept + [("7", "A", "d", 2024, "Q1")] * 2 + [("8", "C", "d", 2024, "Q1")])


def test_files_of_an_earlier_session_are_attached(spark):
    path = scratch_path(spark, "attached")
    fact_store.write_fact_partitioned(spark.createDataFrame(ROWS, SCHEMA), path)
    name = fact_table.attach(spark, path, fact_table.fresh_name(spark, "t"))
    assert _rows(spark, name) == SAFE and fact_table.list_partitions(spark, name).count() == 5


def test_a_slice_is_read_alone(spark, table):
    plan = fact_store.scan_partition(spark.table(table), "A", "d", 2024, "Q1")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(province" in text and plan.count() == 2


def test_compaction_keeps_rows_and_readers(spark):
    row = [("1", 1.0, "A", "o'k 100%", 2024, "Q1"), ("2", 2.0, "B", "d", 2024, "Q1")]
    name = fact_table.create(spark.createDataFrame(row, SCHEMA), fact_table.fresh_name(spark, "t"))
    for i in range(12):  # micro-batches into the first slice
        fact_table.append(spark.createDataFrame([(f"x{i}", float(i), *row[0][2:])], SCHEMA).coalesce(1), name)
    reader = spark.table(name)  # planned before
    rows, files = _rows(spark, name), len(reader.inputFiles())
    old = fact_table.compact(spark, name, most_files=4)
    assert len(old) == 1 and files == 14 and len(spark.table(name).inputFiles()) == 2
    assert _rows(spark, name) == rows == sorted(tuple(r) for r in reader.select(
        "transaction_id", "province", "district", "year", "quarter").collect())
    assert fact_table.compact(spark, name, most_files=4) == []
    fact_table.remove_folders(spark, old)
    assert _rows(spark, name) == rows
    fact_table.append(spark.createDataFrame([("y", 1.0, *row[0][2:])], SCHEMA), name)  # the new folder takes rows too
    assert len(_rows(spark, name)) == len(rows) + 1
    fact_table.delete_partition(spark, name, "A", "o'k 100%", 2024, "Q1")
    assert [r[0] for r in _rows(spark, name)] == ["2"]


def test_compaction_makes_files_of_the_target_size(spark):
    rows = spark.range(20_000).selectExpr("cast(id AS string) AS transaction_id", "rand(1) AS amount", "'A' AS province",
                                          "'d' AS district", "2024 AS year", "'Q1' AS quarter")
    name = fact_table.create(rows.limit(0), fact_table.fresh_name(spark, "t"))
    for i in range(10):
        fact_table.append(rows.where(f"transaction_id % 10 = {i}").coalesce(1), name)
    before = fact_table.slice_files(spark, name).first()
    fact_table.compact(spark, name, target_bytes=before["bytes"] // 3, most_files=5)
    after = fact_table.slice_files(spark, name).first()
    assert before["files"] == 10 and 2 <= after["files"] <= 4 and spark.table(name).count() == 20_000
