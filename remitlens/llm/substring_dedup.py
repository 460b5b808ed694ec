"""Substring de-duplication (operator 2): anchors, then a join on run hashes.

No match is extended; runs around shared anchors are compared by hash.

Seeds: of every run of ``min_words`` words the smallest hash of its inner
``SEED_WORDS``-word runs is its anchor (winnowing), so equal runs have equal
anchors at the same place. Documents are joined on anchors; an anchor of only
one document cannot belong to a repeat. Extension: around each shared anchor
the match must reach ``min_words`` words to both sides together, so the runs
that chose it are joined by their own hash, with the smallest document key that
holds each. Runs of a larger key are repeats; neighbouring ones unite to the
maximal repeated spans, which are removed.

The table is packed once into blocks of a few MB (stored in the shared folder).
A block sends each different hash once to the shard that owns its hash range,
and gets one bit per hash back. So a passage in a third of all documents is one
entry per block, all shards are even, no pair of documents is ever formed, and
every step restarts from stored blocks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.llm.words import Words, buffers
from remitlens.session import scratch_path

SEED_WORDS, BLOCK_BYTES, ROW_BYTES, SHARD_BYTES = 5, 2 << 20, 64, 16 << 20
LAST_KEY = np.iinfo(np.int64).max


def _schema(fields) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def packed_blocks(docs: DataFrame, text: str, size_of: int | None = None, level: int = 3,
                  window: int = 0) -> DataFrame:
    """The rows of ``docs`` in compressed blocks (block, rows, n_bytes) of about
    ``size_of`` bytes of text, stored. ``window``: matches reach back so many bits of
    place (0: as the level has it)."""
    place, most = docs.columns.index(text), size_of or BLOCK_BYTES

    def run(batches):
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        packer = zstandard.ZstdCompressor(level) if not window else zstandard.ZstdCompressor(
            compression_params=zstandard.ZstdCompressionParameters.from_level(level, window_log=window))

        def block():
            table = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([packer.compress(sink.getvalue())], pa.binary()),
                 pa.array([size], pa.int64())], names=["block", "rows", "n_bytes"])

        for batch in batches:
            # a row counts with its text and some bytes more, so many empty texts fill a block too
            ends = buffers(batch.column(place))[1] + ROW_BYTES * np.arange(batch.num_rows + 1)
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + most - size, side="right")) - 1)
                held.append(batch.slice(lo, hi - lo))
                size += int(ends[hi] - ends[lo])
                lo = hi
                if size >= most or lo < batch.num_rows:
                    yield block()
                    number, held, size = number + 1, [], 0
        if held:
            yield block()

    path = scratch_path(docs.sparkSession, "blocks")
    packed = docs.mapInArrow(run, "block bigint, rows binary, n_bytes bigint")
    packed.write.option("compression", "none").parquet(path)
    return docs.sparkSession.read.schema(packed.schema).parquet(path)


def unpacked(rows: bytes) -> pa.RecordBatch:
    table = pa.ipc.open_stream(zstandard.decompress(rows)).read_all().combine_chunks()
    return table.to_batches()[0]


class Runs:
    """Runs of ``size`` words of a block's rows: ``hash``, ``row``, ``at`` (place
    of the first word) and ``anchor`` (hash of the anchor) of each."""

    def __init__(self, batch: pa.RecordBatch, key: int, text: int, size: int):
        self.words = Words(batch.column(text))
        # a null key counts as larger than every other
        self.keys = pc.fill_null(batch.column(key).cast(pa.int64()), LAST_KEY).to_numpy(zero_copy_only=False)
        whole, inside = self.words.grams(size)
        self.at = np.flatnonzero(inside)
        self.hash = whole[self.at]
        self.row = self.words.row_of()[self.at]
        seeds, _ = self.words.grams(min(SEED_WORDS, size))
        if len(self.at):
            span = sliding_window_view(seeds, size - min(SEED_WORDS, size) + 1)
            self.anchor = np.concatenate([span[some].min(axis=1) for some in np.array_split(
                self.at, 1 + len(self.at) // 100_000)])
        else:
            self.anchor = np.zeros(0, np.uint64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(sorted different anchors, whether two or more keys of the block hold each)."""
        keys = self.keys[self.row]
        order = np.lexsort((keys, self.anchor))
        anchor, keys = self.anchor[order], keys[order]
        first = _firsts(anchor)
        several = np.zeros(len(first), dtype=bool)
        if len(first):
            several = np.minimum.reduceat(keys, first) != np.maximum.reduceat(keys, first)
        return anchor[first], several

    def seeded(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs whose anchor is among ``shared``: (their places here, sorted
        different hashes, the smallest key of the block for each)."""
        places = np.flatnonzero(np.isin(self.anchor, shared))
        hash_, keys = self.hash[places], self.keys[self.row[places]]
        order = np.lexsort((keys, hash_))
        hash_, keys = hash_[order], keys[order]
        first = _firsts(hash_)
        return places, hash_[first], keys[first]


def _firsts(ordered: np.ndarray) -> np.ndarray:
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


def _by_shard(block: int, hashes: np.ndarray, value: np.ndarray, shards: int):
    """One row per shard that owns some of the sorted hashes: equal ranges of the hash."""
    step = (1 << 64) // shards + 1
    cuts = np.searchsorted(hashes, np.array([step * s for s in range(1, shards)], dtype=np.uint64))
    edges = [0, *cuts.tolist(), len(hashes)]
    own = [s for s in range(shards) if edges[s] < edges[s + 1]]
    return pa.RecordBatch.from_arrays(
        [pa.array(own, pa.int32()), pa.array([block] * len(own), pa.int64()),
         pa.array([hashes[edges[s]:edges[s + 1]].tobytes() for s in own], pa.binary()),
         pa.array([value[edges[s]:edges[s + 1]].tobytes() for s in own], pa.binary())],
        names=["shard", "block", "hashes", "value"])


def _answers(sent: DataFrame, judge, kind: type) -> DataFrame:
    """Per block the bits that ``judge(inverse, values)`` gives its hashes, in
    their order: (block, bits: array of (shard, bits))."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        hashes = np.frombuffer(b"".join(rows["hashes"]), dtype=np.uint64)
        values = np.frombuffer(b"".join(rows["value"]), dtype=kind)
        inverse = np.unique(hashes, return_inverse=True)[1]
        bits = judge(inverse, values)
        ends = np.cumsum([len(h) // 8 for h in rows["hashes"]])
        return pd.DataFrame({"block": rows["block"], "shard": rows["shard"],
                             "bits": [np.packbits(b).tobytes() for b in np.split(bits, ends[:-1])]})

    told = sent.groupBy("shard").applyInPandas(one, "block bigint, shard int, bits binary")
    return told.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("shard", "bits"))).alias("bits"))


def _in_several(inverse: np.ndarray, several: np.ndarray) -> np.ndarray:
    return np.bincount(inverse, weights=1 + several.astype(np.int64))[inverse] >= 2


def _held_by_smaller(inverse: np.ndarray, keys: np.ndarray) -> np.ndarray:
    least = np.full(int(inverse.max()) + 1, LAST_KEY)
    np.minimum.at(least, inverse, keys)
    return least[inverse] < keys


def _told(hashes: np.ndarray, bits, shards: int) -> np.ndarray:
    """A block's bits for its sorted hashes."""
    step = (1 << 64) // shards + 1
    shard = np.searchsorted(np.array([step * s for s in range(1, shards)], dtype=np.uint64), hashes, side="right")
    out = np.zeros(len(hashes), dtype=bool)
    for s, packed in bits:
        lo, hi = np.searchsorted(shard, [s, s + 1])
        out[lo:hi] = np.unpackbits(np.frombuffer(packed, np.uint8), count=hi - lo)
    return out


def remove_repeats(docs: DataFrame, min_words: int = 13, key: str = "doc_id", text: str = "text",
                   digest: bool = False) -> DataFrame:
    """``docs`` without the words covered by a run of ``min_words`` words that
    also starts in a row with a smaller key, with ``n_words`` (before) and
    ``n_removed``. Runs are judged on the input, not on what is left.

    A changed text is its kept words joined by one space; others stay as they
    are. With ``digest``, ``kept_sha256`` has the digest of the kept words
    joined by one space, for every row.

    A null text has no words and stays null. The key is an integer; a null key
    counts as larger than every other (its repeats go, and it removes nothing
    elsewhere). Rows with equal keys don't remove each other's words. Other
    columns stay (``n_words``, ``n_removed``, ``kept_sha256`` are replaced). An
    empty table gives no rows. Texts are whole; a text longer than a block is a
    block of its own.
    """
    docs = docs.drop("n_words", "n_removed", "kept_sha256")
    key_at, text_at = docs.columns.index(key), docs.columns.index(text)
    blocks = packed_blocks(docs, text)
    n_bytes = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    shards = max(8, -(-n_bytes // SHARD_BYTES))

    def send_anchors(batches):
        for batch in batches:
            for block, rows in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield _by_shard(block, *Runs(unpacked(rows.as_py()), key_at, text_at, min_words).anchors(), shards)

    sent = "shard int, block bigint, hashes binary, value binary"
    shared = _answers(blocks.select("block", "rows").mapInArrow(send_anchors, sent), _in_several, bool)

    def send_runs(batches):
        for batch in batches:
            for block, rows, bits in _rows(batch):
                runs = Runs(unpacked(rows), key_at, text_at, min_words)
                anchors, _ = runs.anchors()
                _, hashes, keys = runs.seeded(anchors[_told(anchors, bits[0], shards)])
                if len(hashes):
                    yield _by_shard(block, hashes, keys, shards)

    seeds = _stored(shared.withColumnRenamed("bits", "seed_bits"))
    with_seeds = blocks.drop("n_bytes").join(seeds.hint("shuffle_hash"), "block", "left")
    repeated = _answers(with_seeds.mapInArrow(send_runs, sent), _held_by_smaller, np.int64)
    both = with_seeds.join(repeated.withColumnRenamed("bits", "run_bits").hint("shuffle_hash"), "block", "left")
    fields = docs.schema.fields
    out = _schema(fields) + ", n_words bigint, n_removed bigint" + (", kept_sha256 string" if digest else "")

    def remove(batches):
        for batch in batches:
            for _, rows, bits in _rows(batch):
                own = unpacked(rows)
                runs = Runs(own, key_at, text_at, min_words)
                anchors, _ = runs.anchors()
                places, hashes, keys = runs.seeded(anchors[_told(anchors, bits[0], shards)])
                gone = np.zeros(len(runs.words.hash) + 1, dtype=np.int64)
                if len(places):
                    at = np.searchsorted(hashes, runs.hash[places])
                    repeat = _told(hashes, bits[1], shards)[at] | (runs.keys[runs.row[places]] > keys[at])
                    begin = runs.at[places[repeat]]
                    np.add.at(gone, begin, 1)
                    np.add.at(gone, begin + min_words, -1)
                gone = np.cumsum(gone[:-1]) > 0
                edge = runs.words.rows
                total = np.concatenate([[0], np.cumsum(gone)])
                removed = total[edge[1:]] - total[edge[:-1]]
                texts, digests = own.column(text_at).to_pylist(), []
                for i, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)):
                    if digest or removed[i]:
                        words = (texts[i] or "").encode().split()
                        kept = b" ".join([w for w, g in zip(words, gone[a:b].tolist(), strict=True) if not g]
                                         if removed[i] else words)
                        if digest:
                            digests.append(hashlib.sha256(kept).hexdigest())
                        if removed[i]:
                            texts[i] = kept.decode()
                columns = list(own.columns)
                columns[text_at] = pa.array(texts, pa.string())
                columns += [pa.array(np.diff(edge), pa.int64()), pa.array(removed, pa.int64())]
                columns += [pa.array(digests, pa.string())] if digest else []
                names = [f.name for f in fields] + ["n_words", "n_removed"] + (["kept_sha256"] if digest else [])
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return both.mapInArrow(remove, out)


def _rows(batch: pa.RecordBatch):
    """(block, packed rows, the lists of (shard, bits)) of each row of a batch."""
    for i in range(batch.num_rows):
        bits = [[(b["shard"], b["bits"]) for b in batch.column(c)[i].as_py() or []]
                for c in range(2, batch.num_columns)]
        yield batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), bits


def _stored(rows: DataFrame) -> DataFrame:
    path = scratch_path(rows.sparkSession, "bits")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
