"""A training-text pipeline over ``documents`` in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``; ``n_chars`` follows the text.

1. toxicity: documents that the compression-distance classifier rejects go.
2. line_dedup: lines that ten or more documents hold go from all of them.
3. near_duplicates: of documents linked by five-word shingles (0.75) one stays.
4. substring_dedup: words of runs of 13 that an earlier document holds go.
5. packing: what is left becomes sequences of 2048 tokens.

The classifier, the Jaccard join's hashes and the tokenizer have no SQL form, so
``ORACLE_SQL`` is None; tests compare the stages with brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.llm import jaccard_join, line_dedup, packing, substring_dedup, toxicity
from remitlens.session import remove_path, scratch_path, scratch_since

ORACLE_SQL = None
_LEFT: list[str] = []  # scratch tables of stages that were built before


def _stage(build):
    """A stage that first removes the scratch tables of the stages before it:
    their rows have been written when the next stage is built (tables that
    ``docs`` still reads stay)."""
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles()
        for path in [p for p in _LEFT if not any(p in f for f in read)]:
            remove_path(spark, path)
            _LEFT.remove(path)
        _, mark = scratch_since()
        out = build(spark, docs, sf_dir)
        _LEFT.extend(scratch_since(mark)[0])
        return out
    return stage


def _as_documents(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with ``n_chars`` as the text has it now."""
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))
    return out.select(*docs.columns)


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(docs, model, threshold=0.3).where("predicted = 0").select(*docs.columns)


@_stage
def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _as_documents(line_dedup.drop_common_lines(docs, min_docs=10, min_chars=1), docs)


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs, percent=75, k=5)


@_stage
def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _as_documents(substring_dedup.remove_repeats(docs, min_words=13), docs)


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), size=2048, end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", drop_repeats),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written and read again, over ``documents``."""
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        before, path = path, scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_path(spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)
