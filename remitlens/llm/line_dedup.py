"""Line de-duplication (operator 1): levelled sorted runs of line hashes.

``LineRuns`` keeps how many documents hold each line, as runs sorted by the
line's hash. A batch of documents first merge-anti-joins the keys that the runs
have already proven common (their count is settled), then adds its own counts
as a new run on level 0. When a level holds ``fanout`` runs, they are merged
into one run of the next level, and keys that reach ``min_docs`` move to the
proven keys. Only DataFrame operations are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.session import scratch_path

SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(text: Column) -> Column:
    """The key of each line: white space stripped at both ends, A-Z in lower case."""
    return F.transform(split_lines(F.translate(text, UPPER, LOWER)), lambda x: F.btrim(x, F.lit(SPACES)))


class LineRuns:
    """Document counts of line hashes ``(h1, h2)`` in levelled sorted runs."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[DataFrame]] = []
        self.proven: list[DataFrame] = []

    def _stored(self, rows: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"line-{name}")
        rows.sortWithinPartitions(*KEY).write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def add(self, lines: DataFrame) -> None:
        """Add a batch: rows (h1, h2, and the document's key columns) of documents
        that no other batch holds; a line may repeat inside a document."""
        for known in self.proven:
            lines = lines.join(known.hint("merge"), KEY, "left_anti")
        # first a document's repeats, then the documents
        counts = lines.distinct().groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
        self._push(0, self._stored(counts, "run"))

    def _push(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self._stored(self._merged(self.levels[level]), "level")
            self.levels[level] = []
            self.proven.append(merged.where(F.col("n") >= self.min_docs).select(*KEY))
            self._push(level + 1, merged.where(F.col("n") < self.min_docs))

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, runs).groupBy(*KEY).agg(F.sum("n").alias("n"))

    def common(self) -> DataFrame:
        """Keys that at least ``min_docs`` documents of all batches hold."""
        out = list(self.proven)
        if rest := [run for level in self.levels for run in level]:
            out.append(self._merged(rest).where(F.col("n") >= self.min_docs).select(*KEY))
        return reduce(DataFrame.unionByName, out)


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text: str = "text",
                      key: str = "doc_id", batches: int = 4, fanout: int = 2) -> DataFrame:
    """``docs`` with all lines removed whose key (of at least ``min_chars`` code
    points) at least ``min_docs`` documents hold, and ``n_lines`` (before),
    ``n_dropped``; ``text`` holds the kept lines joined by a line end.

    A document is a key with a text: copies under other keys count again, rows
    repeated in both count once (and all of them get the result). A line counts
    once for a document. A null or empty text is one empty line, kept as an
    empty text. A null key is a key like others. Other columns stay, whatever
    their names (but ``n_lines`` and ``n_dropped`` are replaced). An empty table
    gives no rows. Lines are told apart by 128 bits of hash.
    """
    spark = docs.sparkSession
    own = F.struct(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("at"))
    lines = docs.select(own.alias("doc"), F.posexplode(line_keys(F.col(text))).alias("pos", "line")) \
        .where(F.char_length("line") >= max(1, min_chars)) \
        .select("doc.id", "doc.at", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"))
    path = scratch_path(spark, "lines")
    # all rows of a document fall into one batch; sorted, a file's pages hold a batch each, so that one file a task is
    # enough (every file that is written takes executor memory for its buffers and its file system commands)
    lines.withColumn("batch", F.pmod(F.xxhash64("id", "at"), F.lit(batches)).cast("int")) \
        .sortWithinPartitions("batch").write.parquet(path)
    stored = spark.read.schema("id " + docs.schema[key].dataType.simpleString()
                               + ", at long, pos int, h1 long, h2 long, batch int").parquet(path)
    runs = LineRuns(spark, min_docs, fanout)
    for b in range(batches):
        runs.add(stored.where(F.col("batch") == b).select("id", "at", *KEY))
    # places to drop, per document
    hits = stored.join(runs.common().hint("merge"), KEY).groupBy("id", "at") \
        .agg(F.sort_array(F.collect_set("pos")).alias("__drop"))
    out = docs.withColumn("__at", F.xxhash64(F.col(text))).alias("d").join(
        hits.alias("h"), F.col(f"d.{key}").eqNullSafe(F.col("h.id")) & (F.col("d.__at") == F.col("h.at")), "left")
    whole = split_lines(F.col(f"d.{text}"))
    gone = F.coalesce(F.col("h.__drop"), F.expr("cast(array() as array<int>)"))
    # the kept stretches between dropped places, in one pass over the lines (split once, as a lambda's argument)
    stretches = F.get(F.transform(F.array(whole), lambda lines: F.zip_with(
        F.concat(F.array(F.lit(-1)), gone), F.concat(gone, F.array(F.size(lines))),
        lambda a, b: F.slice(lines, a + 2, b - a - 1))), F.lit(0))
    kept = F.when(F.size(gone) == 0, F.coalesce(F.col(f"d.{text}"), F.lit(""))) \
        .otherwise(F.array_join(F.flatten(stretches), "\n"))
    keep = [F.col(f"d.`{c}`") for c in docs.columns if c not in (text, "n_lines", "n_dropped")]
    return out.select(*keep, kept.alias(text), F.size(whole).cast("long").alias("n_lines"),
                      F.size(gone).cast("long").alias("n_dropped"))
