"""A trie of conversations by shared prefixes (operator 12), screened by a count-min sketch.

Texts leave the first scan as digests, so only narrow rows move. Each rebuilt
conversation gets a chained digest of every prefix. A count-min sketch counts
conversations by prefix digest: its estimates are never too low, so an estimate
of one proves that a prefix, and with it every longer one, belongs to one
conversation alone. These tails become nodes where they are; only prefixes that
may be shared are shuffled and grouped exactly.

No step goes down the trie level by level. The smallest member owns a node, and
owns all that follows on its path, so each conversation owns one stretch of its
path. What a subtree holds is a sum over its members of two figures of each:
the words before its own stretch, and whether its end is a childless node of
its own.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.session import materialize

ROWS = 2                      # rows of the sketch
CELLS_PER_PREFIX = 8          # cells of a row for each prefix, up to MOST_CELLS
LEAST_CELLS, MOST_CELLS = 1 << 12, 1 << 25   # at most 16 MB are broadcast: 2 bits a cell, 2 rows
STRIP = 1 << 16               # cells of one message
IDS_PER_PIECE = 10_000
ROOT = b""
_MIX = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- conversations

def _turns(conversations: DataFrame) -> DataFrame:
    """(conv, turn, said, w): each turn's role and text as 16 bytes, and the words of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(said, 1, 32)).alias("said"),
        F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("w"))


def borrowed(conv: Column) -> Column:
    """How many turns a conversation takes from its donor."""
    return (F.crc32(conv.cast("string").cast("binary")) % 4).cast("int")


def rebuilt(conversations: DataFrame, group: int = 20) -> DataFrame:
    """(conv, pos, said, w) of all rebuilt conversations, and a row of position 0
    for each: the first turns of conversation ``conv - conv % group``, then its
    own after as many."""
    w = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "said")
    placed = materialize(_turns(conversations).withColumn("pos", F.row_number().over(w)).drop("turn"))
    convs = placed.where("pos = 1").select("conv", (F.col("conv") - F.col("conv") % group).alias("donor"),
                                           borrowed(F.col("conv")).alias("h"))
    first = placed.where(f"pos <= 3 AND conv % {group} = 0").withColumnRenamed("conv", "donor")
    given = convs.join(first, "donor").where("pos <= h").select("conv", "pos", "said", "w")
    own = placed.where(F.col("pos") > borrowed(F.col("conv"))).select("conv", "pos", "said", "w")
    start = convs.select("conv", F.lit(0).alias("pos"), F.lit(b"").alias("said"), F.lit(0).cast("long").alias("w"))
    return given.unionByName(own).unionByName(start)


_CHAIN = "conv bigint, depth bigint, digest binary, parent binary, w bigint, before bigint, ends boolean"


def _chain(batches):
    """Digest of every prefix along sorted (conv, pos) rows; the running state is
    one digest and one sum, and the last row is held back until it is known
    whether the conversation ends with it."""
    conv = state = held = None
    depth = before = 0
    for batch in batches:
        out = []
        for c, pos, said, w in zip(*(col.to_pylist() for col in batch.columns), strict=True):
            if held is not None:
                out.append((*held, c != held[0]))
            if pos == 0:
                conv, state, depth, before = c, ROOT, 0, 0
                held = (c, 0, ROOT, None, 0, 0)
            else:
                digest = hashlib.blake2b(state + said, digest_size=16).digest()
                depth += 1
                held = (conv, depth, digest, state, w, before)
                state, before = digest, before + w
        if out:
            yield _batch(out, _CHAIN)
    if held is not None:
        yield _batch([(*held, True)], _CHAIN)


_TYPES = {"bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string(), "int": pa.int32()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(col, _TYPES[kind]) for col, (_, kind) in zip(zip(*rows), fields, strict=True)],
                                      names=[name for name, _ in fields])


# ---------------------------------------------------------------- count-min sketch

def _cells(digests: pa.Array, cells: int) -> list[np.ndarray]:
    """The cell of each 16-byte digest in each row of the sketch."""
    halves = np.frombuffer(b"".join(digests.to_pylist()), dtype=np.uint64).reshape(-1, 2)
    return [((halves[:, r] * _MIX) >> np.uint64(64 - (cells.bit_length() - 1))).astype(np.int64) for r in range(ROWS)]


def _pack(counts: np.ndarray) -> bytes:
    c = counts.reshape(-1, 4)
    return (c[:, 0] | c[:, 1] << 2 | c[:, 2] << 4 | c[:, 3] << 6).astype(np.uint8).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, dtype=np.uint8)
    return np.stack([b >> s & 3 for s in (0, 2, 4, 6)], axis=1).ravel()


def count_min(chain: DataFrame, cells: int) -> list[bytes]:
    """The sketch of all prefix digests, with counts up to two (2 bits a cell).
    Tasks send only strips that they touched, compressed; strips are summed as
    they come in. At most ``ROWS * cells / 4`` bytes reach the driver."""
    strip = min(STRIP, cells)

    def count(batches):
        counts = np.zeros((ROWS, cells), dtype=np.uint8)
        for batch in batches:
            for row, at in enumerate(_cells(batch.column(0), cells)):
                at, n = np.unique(at, return_counts=True)
                counts[row, at] = np.minimum(counts[row, at] + np.minimum(n, 2), 2)
        for row in range(ROWS):
            for i in range(0, cells, strip):
                part = counts[row, i:i + strip]
                if part.any():
                    yield _batch([(row, i // strip, zlib.compress(_pack(part), 1))], "row int, strip int, data binary")

    def merge(batches):
        at = total = None
        for batch in batches:
            for row, i, data in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if at != (row, i):
                    if at is not None:
                        yield _batch([(*at, _pack(total))], "row int, strip int, data binary")
                    at, total = (row, i), np.zeros(strip, dtype=np.uint8)
                total = np.minimum(total + _unpack(zlib.decompress(data)), 2)
        if at is not None:
            yield _batch([(*at, _pack(total))], "row int, strip int, data binary")

    schema = "row int, strip int, data binary"
    parts = chain.where("depth > 0").select("digest").mapInArrow(count, schema) \
        .repartition("row", "strip").sortWithinPartitions("row", "strip").mapInArrow(merge, schema)
    sketch = [bytearray(cells // 4) for _ in range(ROWS)]
    for r in parts.collect():
        sketch[r["row"]][r["strip"] * strip // 4:(r["strip"] + 1) * strip // 4] = r["data"]
    return [bytes(s) for s in sketch]


def screened(chain: DataFrame, cells: int) -> DataFrame:
    """``chain`` with ``kind``: shared (may have several members), head (the first
    prefix proven to belong to one conversation) or tail (what follows it). The
    rows of a conversation must lie together by rising depth, as ``chain`` leaves
    them."""
    sketch = chain.sparkSession.sparkContext.broadcast(count_min(chain, cells))

    def run(batches):
        rows = [np.frombuffer(s, dtype=np.uint8) for s in sketch.value]
        proven_conv = None
        for batch in batches:
            depth = batch.column(1).to_numpy()
            least = np.full(len(depth), 3, dtype=np.uint8)
            some = np.flatnonzero(depth > 0)
            if len(some):
                at = _cells(batch.column(2).take(pa.array(some)), cells)
                least[some] = np.min([row[c >> 2] >> ((c & 3) << 1).astype(np.uint8) & 3 for row, c in zip(rows, at, strict=True)], axis=0)
            kinds = []
            for conv, single in zip(batch.column(0).to_pylist(), (least == 1).tolist(), strict=True):
                if conv == proven_conv:
                    kinds.append("tail")
                elif single:
                    proven_conv = conv
                    kinds.append("head")
                else:
                    kinds.append("shared")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kinds, pa.string())],
                                             names=[*batch.schema.names, "kind"])

    return chain.mapInArrow(run, _CHAIN + ", kind string")


# ---------------------------------------------------------------- ends

def _ends(rows: DataFrame) -> DataFrame:
    """(digest, ends_sha256) over (digest, conv): the ids in rising order, joined
    by commas. A digest may hold a large part of all ids, so they are sorted by
    ranges of (digest, id) into pieces of text, and only the hash goes through
    the pieces of one digest in turn."""
    def pieces(batches):
        at, first, ids = None, None, []
        for batch in batches:
            out = []
            for digest, conv in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if digest != at or len(ids) == IDS_PER_PIECE:
                    if ids:
                        out.append((at, first, ",".join(ids)))
                    at, first, ids = digest, conv, []
                ids.append(str(conv))
            if out:
                yield _batch(out, "digest binary, first bigint, ids string")
        if ids:
            yield _batch([(at, first, ",".join(ids))], "digest binary, first bigint, ids string")

    def hashes(batches):
        at = sha = None
        for batch in batches:
            out = []
            for digest, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if digest != at:
                    if at is not None:
                        out.append((at, sha.hexdigest()))
                    at, sha = digest, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if out:
                yield _batch(out, "digest binary, ends_sha256 string")
        if at is not None:
            yield _batch([(at, sha.hexdigest())], "digest binary, ends_sha256 string")

    ranged = rows.repartitionByRange("digest", "conv").sortWithinPartitions("digest", "conv")
    return ranged.mapInArrow(pieces, "digest binary, first bigint, ids string") \
        .repartition("digest").sortWithinPartitions("digest", "first") \
        .mapInArrow(hashes, "digest binary, ends_sha256 string")


# ---------------------------------------------------------------- the trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(conversations: DataFrame, group: int = 20, cells: int | None = None) -> DataFrame:
    """The nodes of the trie of rebuilt conversations (columns ``COLUMNS``).

    Turns are ordered by ``turn`` (null first; equal ones by the SHA-256 of role
    and text); a null role or text is empty. Rows without a conv_id take no part.
    Repeated rows are turns of their own. An empty table has no conversation and
    so no node, not even the root. Other columns are not read.

    ``cells`` (a power of two) sets the width of the sketch; by default it has 8
    cells a prefix, 2^25 at most. A narrow sketch proves less and shuffles more;
    the nodes are the same. Hot prefixes are counted before the shuffle; the
    joins that give a hot prefix's owner to its children are split by AQE.
    """
    chain = materialize(rebuilt(conversations, group).repartition("conv").sortWithinPartitions("conv", "pos")
                        .select("conv", "pos", "said", "w").mapInArrow(_chain, _CHAIN))
    if cells is None:
        cells = 1 << (chain.count() * CELLS_PER_PREFIX - 1).bit_length()
        cells = max(LEAST_CELLS, min(MOST_CELLS, cells))
    rows = materialize(screened(chain, cells))
    shared, head = rows.where("kind = 'shared'"), rows.where("kind = 'head'")

    # exact groups of the prefixes that may be shared (a digest fixes depth, parent and words before);
    # single children are counted at their parent
    groups = materialize(shared.groupBy("digest", "depth", "parent", "before").agg(
        F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n"), F.sum(F.col("ends").cast("long")).alias("n_ends")))
    children = groups.where("parent IS NOT NULL").select("parent").unionByName(head.select("parent")) \
        .groupBy(F.col("parent").alias("digest")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(groups.join(children, "digest", "left")
                        .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))

    # one row a conversation: words before its own stretch, and whether it ends in a childless node of its own
    owned = nodes.groupBy(F.col("owner").alias("conv")).agg(
        F.min("before").alias("own_before"), F.max((F.col("n_children") == 0).cast("long")).alias("own_leaf"))
    closing = rows.where("kind = 'head' OR (kind = 'shared' AND ends)").select(
        "conv", F.when(F.col("kind") == "head", F.col("before")).otherwise(F.col("before") + F.col("w")).alias("upto"),
        (F.col("kind") == "head").cast("long").alias("leaf"))
    each = closing.join(owned, "conv", "left").select(
        "conv", F.coalesce("own_before", "upto").alias("shared_words"),
        F.greatest("leaf", F.coalesce("own_leaf", F.lit(0))).alias("leaf"))
    sums = shared.select("conv", "digest").join(each, "conv").groupBy("digest").agg(
        F.sum("shared_words").alias("shared_words"), F.sum("leaf").alias("n_leaves"))
    # the owner's share is that of the node's owner; it is taken off by a join on the conversation
    totals = nodes.join(sums, "digest").join(
        each.select(F.col("conv").alias("owner"), F.col("shared_words").alias("owner_words")), "owner")
    totals = totals.withColumn("saved_tokens", F.col("shared_words") - F.col("owner_words")
                               - (F.col("n") - 1) * F.col("before"))

    ends = _ends(materialize(shared.where("ends").select("digest", "conv")))
    totals = totals.join(ends, "digest", "left")

    # a node's parent belongs to another conversation only where the owner's stretch begins
    owners = nodes.select(F.col("digest").alias("parent"), F.col("owner").alias("parent_conv_id"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    exact = totals.select("owner", "depth", "parent", "n", "n_children", "n_leaves", "saved_tokens",
                          F.coalesce("ends_sha256", none).alias("ends_sha256"))
    single = head.select(F.col("conv").alias("owner"), "depth", "parent", F.lit(1).cast("long").alias("n"),
                         (~F.col("ends")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
                         F.lit(0).cast("long").alias("saved_tokens"), _one_end(F.col("ends"), F.col("conv")))
    tops = exact.unionByName(single)
    root = nodes.where("depth = 0").select(F.col("owner")).first()  # one row
    root_owner = F.lit(root[0] if root else None).cast("long")
    upper = tops.where("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, root_owner)).drop("parent")
    lower = tops.where("depth > 1").join(owners, "parent").drop("parent")
    tail = rows.where("kind = 'tail'").select(
        F.col("conv").alias("owner"), "depth", F.lit(1).cast("long").alias("n"),
        (~F.col("ends")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"), _one_end(F.col("ends"), F.col("conv")),
        F.col("conv").alias("parent_conv_id"))
    return upper.unionByName(lower).unionByName(tail).select(
        F.col("owner").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
        "n_leaves", "saved_tokens", "ends_sha256")


def _one_end(ends: Column, conv: Column) -> Column:
    return F.sha2(F.when(ends, conv.cast("string")).otherwise("").cast("binary"), 256).alias("ends_sha256")
