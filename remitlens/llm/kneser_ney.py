"""Quality classifier (operator 7): interpolated modified Kneser-Ney perplexity.

An n-gram model over the bytes of texts (``ORDER`` bytes, the start of a text
padded) is trained on all trusted documents but a held-back quarter. The table is
packed once into blocks; a block sends each different n-gram, with its count in
trusted text, to the shard that owns the n-gram. Which rows of a block train is
one bit a row, from a join of keys, so no text is shuffled for it. The shards' rows are the n-grams of the whole
corpus. Counts of all orders, discounts and interpolation weights come from
joins of these tables on n-gram, context and suffix, and the shards answer each
block with the log-probabilities of its n-grams. Sums over a document give its
perplexity. A document is kept if its perplexity is within its language's
quantile over all trusted documents that training did not see.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlens.llm.substring_dedup import packed_blocks, unpacked
from remitlens.llm.words import buffers, mix, slices
from remitlens.session import materialize

ORDER, BLOCK_BYTES, SHARD_BLOCKS, MOST_TRUSTED = 5, 32 << 20, 4, None
PLACE_BITS = 64 - 8 * ORDER  # what an n-gram leaves of a number
QUANTILE, SLACK, LEAST_SEEN = 0.99, 1.1, 30


def byte_grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram that ends at each byte as a number, row ends with a leading 0)."""
    flat, ends = buffers(column)
    out = np.zeros(len(flat), dtype=np.uint64)
    at = np.arange(len(flat)) - np.repeat(ends[:-1], np.diff(ends))  # place in the row
    for back in range(ORDER):
        byte = np.zeros(len(flat), dtype=np.uint64)
        byte[back:] = flat[:len(flat) - back]
        byte[at < back] = 0
        out |= byte << np.uint64(8 * back)
    return out, ends


def _sliced(column: pa.Array):
    for lo, hi in slices(column):
        yield lo, hi, *byte_grams(column.slice(lo, hi - lo))


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Whether each sorted value differs from the one before."""
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return new


def _different(parts: list[np.ndarray]) -> np.ndarray:
    """Sorted different values."""
    ordered = np.sort(np.concatenate([np.zeros(0, np.uint64), *parts]))
    return ordered[_firsts(ordered)]


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different values and how often each comes."""
    ordered = np.sort(values)
    at = np.flatnonzero(_firsts(ordered))
    return ordered[at], np.diff(np.append(at, len(ordered)))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different n-grams and their summed counts."""
    grams, inverse = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(inverse, weights=np.concatenate([c for _, c in parts])).astype(np.int64)


def _with_places(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted different n-grams, the place of each n-gram among them)."""
    if len(grams) >> PLACE_BITS:  # one very long text
        return np.unique(grams, return_inverse=True)
    both = np.sort((grams << np.uint64(PLACE_BITS)) | np.arange(len(grams), dtype=np.uint64))
    at = (both & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    both >>= np.uint64(PLACE_BITS)
    new = _firsts(both)
    inverse = np.empty(len(grams), np.int64)
    inverse[at] = np.cumsum(new) - 1
    return both[new], inverse


def block_grams(column: pa.Array) -> np.ndarray:
    """The sorted different n-grams of a block's texts."""
    return _different([_different([grams]) for _, _, grams, _ in _sliced(column)])


def trained_grams(column: pa.Array, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted different n-grams of a block's texts, their counts in the rows that ``learn`` marks)."""
    every, parts = [], []
    for lo, hi, grams, ends in _sliced(column):
        every.append(_different([grams]))
        parts.append(_counted(grams[np.repeat(learn[lo:hi], np.diff(ends))]))
    own = _different(every)
    c = np.zeros(len(own), np.int64)
    if parts:
        grams, counts = _merged(parts)
        c[np.searchsorted(own, grams)] = counts
    return own, c


def _packed(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes(), 3)


def _array(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype=kind)


def _packed_floats(values: np.ndarray) -> bytes:
    """float32 values by place of the byte, which packs better and loses nothing."""
    return _packed(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 4).T))


def _floats(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(_array(data, np.uint8).reshape(4, -1).T).view(np.float32).ravel()


def _gaps(grams: np.ndarray) -> bytes:
    return _packed(np.diff(grams, prepend=np.uint64(0)))


def _from_gaps(data: bytes) -> np.ndarray:
    return np.cumsum(_array(data, np.uint64), dtype=np.uint64)


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and 3 or more."""
    n = [0, *counts.agg(*[F.count_if(F.col("c") == k) for k in (1, 2, 3, 4)]).first()]
    if not n[1] or not n[2]:
        return 0.5, 0.75, 0.9
    y = n[1] / (n[1] + 2 * n[2])
    found = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else k / 2 for k in (1, 2, 3)]
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), found, strict=True))


def log_probabilities(corpus: DataFrame) -> DataFrame:
    """(shard, gram, logp) for every n-gram of ``corpus`` (shard, gram, c), where
    c is its count in training text (0: not seen there)."""
    seen = {ORDER: materialize(corpus.where("c > 0").select("gram", "c"))}
    for m in range(ORDER - 1, 0, -1):  # lower orders count the different bytes in front
        seen[m] = materialize(seen[m + 1].groupBy(F.col("gram").bitwiseAND((1 << 8 * m) - 1).alias("gram"))
                              .agg(F.count(F.lit(1)).alias("c")))
    lower = None
    for m in range(1, ORDER + 1):
        asked = corpus.select("shard", "gram") if m == ORDER else \
            corpus.select(F.col("gram").bitwiseAND((1 << 8 * m) - 1).alias("gram")).distinct()
        d1, d2, d3 = discounts(seen[m])
        off = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        context = lambda: F.shiftrightunsigned("gram", 8)
        weights = seen[m].groupBy(context().alias("context")).agg(F.sum("c").alias("total"), F.sum(off).alias("off"))
        rows = asked.withColumn("context", context()) \
            .join(seen[m].withColumn("left", F.col("c") - off).select("gram", "left"), "gram", "left") \
            .join(weights, "context", "left")
        if m == 1:
            below = F.lit(1 / 256)
        else:
            rows = rows.withColumn("suffix", F.col("gram").bitwiseAND((1 << 8 * (m - 1)) - 1)) \
                .join(lower.withColumnsRenamed({"gram": "suffix", "p": "below"}), "suffix")
            below = F.col("below")
        # a context that training did not see leaves everything to the order below
        p = F.when(F.col("total").isNull(), below).otherwise(
            (F.coalesce("left", F.lit(0.0)) + F.col("off") * below) / F.col("total"))
        lower = materialize(rows.select(*(["shard"] if m == ORDER else []), "gram", p.alias("p")))
    return lower.select("shard", "gram", F.log("p").alias("logp"))


def good_keys(labels: DataFrame, key: str, label: str) -> DataFrame:
    return labels.where(F.col(key).isNotNull() & (F.col(label) == 1)).select(key).distinct()


def trusted_keys(labels: DataFrame, key: str, label: str, most: int | None = None) -> DataFrame:
    """All keys labelled good: (key, train). Three quarters of them (by hash) train;
    with ``most``, only of so many (the smallest by hash)."""
    good, train = good_keys(labels, key, label), F.pmod(F.xxhash64(F.lit("held"), key), F.lit(4)) > 0
    if most is None:
        return good.withColumn("train", train)
    some = good.orderBy(F.xxhash64(key), key).limit(most)
    return some.withColumn("train", train).unionByName(
        good.join(some, key, "left_anti").withColumn("train", F.lit(False)))


def training_rows(blocks: DataFrame, trusted: DataFrame, key: str, kind: str) -> DataFrame:
    """(block, learn): one bit for each row of a block, set if its key (the rows' first
    column) is to train. Only keys and places are shuffled."""
    def places(batches):
        for batch in batches:
            for block, rows in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys = unpacked(rows.as_py()).column(0)
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(keys), pa.int64()),
                                                  pa.array(range(len(keys)), pa.int32()), keys],
                                                 names=["block", "place", "key"])

    def bits(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
                [np.packbits(np.bincount(p.values.to_numpy()).astype(bool)).tobytes() for p in batch.column(1)],
                pa.binary())], names=["block", "learn"])

    found = blocks.select("block", "rows").mapInArrow(places, f"block bigint, place int, key {kind}") \
        .join(trusted.where("train").select(F.col(key).alias("key")), "key")
    return found.groupBy("block").agg(F.collect_list("place")).mapInArrow(bits, "block bigint, learn binary")


def quantiles(values: DataFrame, quantile: float) -> DataFrame:
    """(of, q, n): the exact interpolated quantile of ``x`` > 0 for each ``of``, and the
    number of its rows. Counts of fine steps of log x tell which steps hold the two
    values in question, and only these steps' different values are ordered."""
    cells = materialize(values.groupBy("of", "x").agg(F.count(F.lit(1)).alias("m"))
                        .withColumn("step", F.floor(F.log("x") * 1_000)))
    steps = Window.partitionBy("of").orderBy("step")
    place = F.lit(quantile) * (F.col("n") - 1)
    wanted = cells.groupBy("of", "step").agg(F.sum("m").alias("m")) \
        .withColumn("n", F.sum("m").over(Window.partitionBy("of"))) \
        .withColumn("before", F.sum("m").over(steps) - F.col("m")) \
        .withColumns({"low": F.floor(place), "high": F.ceil(place), "share": place - F.floor(place)}) \
        .where((F.col("before") <= F.col("high")) & (F.col("before") + F.col("m") > F.col("low"))) \
        .select(F.col("of").alias("in_of"), F.col("step").alias("in_step"), "n", "before", "low", "high", "share")
    inside = Window.partitionBy("of", "step").orderBy("x")
    ordered = cells.join(wanted, F.col("of").eqNullSafe(F.col("in_of")) & (F.col("step") == F.col("in_step"))) \
        .withColumn("first", F.col("before") + F.sum("m").over(inside) - F.col("m"))
    at = lambda c: F.max(F.when((F.col("first") <= F.col(c)) & (F.col(c) < F.col("first") + F.col("m")), F.col("x")))
    return ordered.groupBy("of").agg(at("low").alias("a"), at("high").alias("b"), F.first("share").alias("share"),
                                     F.first("n").alias("n")) \
        .select("of", ((1 - F.col("share")) * F.col("a") + F.col("share") * F.col("b")).alias("q"), "n")


def perplexities(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                 language: str = "lang", label: str = "quality", most_trusted: int | None = MOST_TRUSTED,
                 quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """Per row of ``docs``: key, language, n_bytes, log_prob, perplexity (per
    byte), threshold and keep (perplexity <= threshold).

    Training takes whole texts of three quarters of all documents that ``labels``
    mark good (``most_trusted``, without a limit by default, bounds how many);
    scoring gathers the n-grams of all documents. The
    threshold is ``slack`` times the language's ``quantile`` of all trusted documents
    that training did not read; a language with fewer than ``LEAST_SEEN`` of them takes that of
    all (infinite without any). A null or empty text has no bytes, a null
    perplexity, and is kept. Null keys and repeated rows are scored like others;
    a null language is a language; other columns are not read. Without trusted
    text every byte has the chance 1/256.
    """
    trusted = trusted_keys(labels, key, label, most_trusted)
    kind = lambda c: docs.schema[c].dataType.simpleString()
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(language).alias("language"))
    # matches over the whole block (window) pack texts better than a higher level
    blocks = packed_blocks(texts, "text", BLOCK_BYTES, level=9, window=25)
    shards = max(4, -(-blocks.count() // SHARD_BLOCKS))

    def by_shard(block, grams, c=None):
        shard = (mix(grams) % np.uint64(shards)).astype(np.int64)
        parts = [np.flatnonzero(shard == s) for s in range(shards)]
        columns = {"shard": pa.array(range(shards), pa.int32()), "block": pa.array([block] * shards, pa.int64()),
                   "grams": pa.array([_gaps(grams[p]) for p in parts], pa.binary())}
        if c is not None:
            columns["counts"] = pa.array([_packed(c[p].astype(np.uint32)) for p in parts], pa.binary())
        return pa.RecordBatch.from_pydict(columns)

    def send_counts(batches):
        for batch in batches:
            for block, rows, learn in zip(batch.column(0).to_pylist(), *batch.columns[1:], strict=True):
                own = unpacked(rows.as_py())
                marks = np.zeros(len(own), dtype=bool)
                if learn.is_valid:
                    found = np.unpackbits(np.frombuffer(learn.as_py(), np.uint8))[:len(own)]
                    marks[:len(found)] = found
                yield by_shard(block, *trained_grams(own.column(1), marks))

    def send(batches):
        for batch in batches:
            for block, rows in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield by_shard(block, block_grams(unpacked(rows.as_py()).column(1)))

    # read twice, and cut again from the blocks the second time: storing the n-grams would take as much as the texts
    sent = blocks.select("block", "rows").mapInArrow(send, "shard int, block bigint, grams binary")
    learn = training_rows(blocks, trusted, key, kind(key))  # a bit for each row of the table in all
    counted = blocks.select("block", "rows").join(F.broadcast(learn), "block", "left") \
        .mapInArrow(send_counts, "shard int, block bigint, grams binary, counts binary")

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [(_from_gaps(g), _array(c, np.uint32)) for g, c in zip(rows["grams"], rows["counts"], strict=True)]
        while len(parts) > 1:  # by pairs, so the largest array is the shard's own n-grams
            parts = [_merged(parts[i:i + 8]) for i in range(0, len(parts), 8)]
        grams, c = parts[0]
        return pd.DataFrame({"shard": np.full(len(grams), rows["shard"].iloc[0], np.int32),
                             "gram": grams.astype(np.int64), "c": c.astype(np.int64)})

    corpus = materialize(counted.groupBy("shard").applyInPandas(count, "shard int, gram bigint, c bigint"))

    def answer(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(known["gram"].to_numpy(), kind="stable")
        grams = known["gram"].to_numpy()[order]
        logp = known["logp"].to_numpy()[order].astype(np.float32)
        return pd.DataFrame({"block": rows["block"], "shard": rows["shard"], "logp": [
            _packed_floats(logp[np.searchsorted(grams, _from_gaps(g).astype(np.int64))]) for g in rows["grams"]]})

    told = sent.select("shard", "block", "grams").groupBy("shard").cogroup(
        log_probabilities(corpus).groupBy("shard")).applyInPandas(answer, "block bigint, shard int, logp binary")
    per_block = told.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("shard", "logp"))).alias("told"))

    def score(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                own = unpacked(batch.column(1)[i].as_py())
                column = own.column(1)
                grams = block_grams(column)
                shard = (mix(grams) % np.uint64(shards)).astype(np.int64)
                logp = np.zeros(len(grams))
                for t in batch.column(2)[i].as_py() or []:
                    logp[shard == t["shard"]] = _floats(t["logp"])
                total, n = np.zeros(len(column)), np.zeros(len(column), np.int64)
                for lo, hi, some, ends in _sliced(column):
                    different, place = _with_places(some)
                    sums = np.concatenate([[0.0], np.cumsum(logp[np.searchsorted(grams, different)][place])])
                    total[lo:hi], n[lo:hi] = sums[ends[1:]] - sums[ends[:-1]], np.diff(ends)
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(2), pa.array(n), pa.array(total)],
                    names=["key", "language", "n_bytes", "log_prob"])

    scored = blocks.select("block", "rows").join(per_block.hint("shuffle_hash"), "block", "left").mapInArrow(
        score, f"key {kind(key)}, language {kind(language)}, n_bytes bigint, log_prob double")
    scored = materialize(scored.withColumn(
        "perplexity", F.when(F.col("n_bytes") > 0, F.exp(-F.col("log_prob") / F.col("n_bytes")))))
    unread = trusted.where(~F.col("train")).select(F.col(key).alias("key"))
    held = materialize(scored.where(F.col("perplexity").isNotNull()).join(unread, "key", "left_semi")
                       .select(F.col("language").alias("of"), F.col("perplexity").alias("x")))
    overall = quantiles(held.withColumn("of", F.lit(0)), quantile).first()
    overall = float("inf") if overall is None else overall["q"]
    limits = quantiles(held, quantile).select("of", F.when(F.col("n") >= LEAST_SEEN, F.col("q")).alias("q"))
    return scored.join(limits, F.col("language").eqNullSafe(F.col("of")), "left") \
        .withColumn("threshold", F.coalesce("q", F.lit(overall)) * slack) \
        .select(F.col("key").alias(key), F.col("language").alias(language), "n_bytes", "log_prob", "perplexity",
                "threshold", (F.col("perplexity").isNull() | (F.col("perplexity") <= F.col("threshold"))).alias("keep"))
