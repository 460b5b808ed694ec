"""N-gram Jaccard join (operator 5) with signature trees.

A document's set holds its distinct word shingles. Documents with equal sets
are one class. Classes meet through keys made of the smallest hashes of a set:

- Sets of up to ``NARROW`` / t shingles send the tokens of the prefix filter: two
  linked sets share one of their |x| - ceil(t |x|) + 1 smallest.
- Sets of ``NARROW`` shingles or more send pairs of neighbours among their
  smallest hashes, ``paired(t)`` of them. Of the union's smallest hashes each is in
  both sets with a chance of at least t, and two such in a row are neighbours in
  both. That none are in a row has a chance below 1e-19 (80 pairs for t = 0.75),
  less than that two 64-bit hashes are equal. A passage that unlike documents
  share rarely makes a pair, which keeps such documents apart from the start.

Linked sets differ in size by t at most, so they send keys of one kind in common.
Sets that send both kinds need neighbours for larger sets only.

Every link between two classes is found: token groups of up to ``PAIRED_ROWS``
classes give all their pairs of fitting sizes, larger ones are searched by signature
trees, which give a pair in the group of its smallest common token only. All pairs
are verified on their exact sets; those of a tree meet their texts in its group, so a
text is sent once for a group, not for a pair. A task takes parts of ``BLOCKS`` times
``GROUP_ROWS`` classes and searches them block by block. No row is made for a pair there: each
class of a group has one row with a list of others, then the number of rows that it
links with in the group and the smallest class it reaches there, from which counts
and components follow. Pairs that meet in large and small groups count in the large.

Who needs the components only (``all_links=False``) has a shortcut:

1. Each class is compared with one class of every token group (its leader).
2. What these links connect needs no more comparison. Token groups that still
   hold several components are searched by signature trees: rows sorted by
   size, nodes with OR-combined bitmaps (about four bits per token; the larger of
   two neighbouring lengths is folded) and size ranges; a dual traversal drops
   node pairs whose largest possible overlap is too small or which lie in one
   component. Groups beyond ``GROUP_ROWS`` are split into pairs of parts.
   ``FOREST_ROUNDS`` times a group gives only as many pairs as would connect all
   its components that may be linked (a forest), which merges near copies by the
   thousand; then once every pair that is left between different components.
3. All these pairs are verified on their exact sets.

There near copies by the thousand cost one link each instead of all pairs, and no
link between components is lost, but links inside a component are not all found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlens.llm.graph import components
from remitlens.llm.words import Words, mix, slices
from remitlens.session import materialize, scratch_path

NARROW, GROUP_ROWS, FANOUT, PAIRED_ROWS = 124, 2_000, 8, 32
BLOCKS = 4  # a task of all links takes parts of so many times GROUP_ROWS, and searches them in blocks of GROUP_ROWS
LEAST_BITS, MOST_BITS = 1_024, 1 << 17
FOREST_ROUNDS, FOREST_TOKENS = 2, 8
SKETCH_PARTS, SKETCH_BITS = 1_024, 32_768  # 4 MB of bits; 32,768 is the length of Spark's bitmaps


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all rows, row ends with a leading 0);
    a row with fewer than k words has its whole sequence as one shingle."""
    words = Words(column, fold_case=True)
    grams, inside = words.grams(k)
    row = words.row_of()[:len(grams)][inside]
    grams = grams[inside]
    n = np.diff(words.rows)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        # mix in the length, so that no short sequence equals a shingle
        whole = [np.add.reduce(words.hash[a:b] * mix(np.arange(1, b - a + 1, dtype=np.uint64)))
                 for a, b in zip(words.rows[short], words.rows[short + 1], strict=True)]
        grams = np.concatenate([grams, mix(np.array(whole, np.uint64) + n[short].astype(np.uint64))])
        row = np.concatenate([row, short])
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    return grams[new], np.searchsorted(row[new], np.arange(len(column) + 1))


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    """How many smallest tokens of a set of n two linked sets must share one of."""
    return n - -(-n * percent // 100) + 1


def paired(percent: int, chance: float = 1e-19) -> int:
    """So many neighbours that two common ones in a row are missing with less than
    ``chance``, if each is common with the share ``percent``."""
    t = percent / 100
    if t >= 1:
        return 1
    rate = ((1 - t) + ((1 - t) ** 2 + 4 * t * (1 - t)) ** 0.5) / 2  # per hash, of having none in a row
    return math.ceil(math.log(chance) / math.log(rate))


def narrow(percent: int) -> int:
    """Sets of up to ``narrow`` / t shingles send single tokens, those of ``narrow`` or more neighbours."""
    return max(NARROW, 2 * paired(percent) // 3 * 2)


def sent_keys(grams: np.ndarray, ends: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys that sets send, ends of each set's keys with a leading 0). Keys of single
    tokens are even, those of neighbours odd."""
    n = np.diff(ends)
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(grams)) - np.repeat(ends[:-1], n)
    single = np.where(n * percent <= narrow(percent) * 100, np.minimum(prefix_size(n, percent), n), 0)
    double = np.where(n >= narrow(percent), np.minimum(n - 1, paired(percent)), 0)
    one = at < single[row]
    two = np.flatnonzero(at < double[row])
    key = np.concatenate([grams[one] & ~np.uint64(1), mix(grams[two] * np.uint64(3) + mix(grams[two + 1])) | np.uint64(1)])
    of = np.concatenate([row[one], row[two]])
    return key[np.argsort(of, kind="stable")], np.concatenate([[0], np.cumsum(single + double)])


def bitmaps(grams: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """A bitmap of each set, with a power of two of bits from three to six times its size."""
    n = np.diff(ends)
    width = np.clip(1 << np.ceil(np.log2(np.maximum(3 * n, 2))).astype(np.int64), LEAST_BITS, MOST_BITS)
    begin = np.cumsum(width) - width
    bits = np.zeros(int(width.sum()), dtype=bool)
    bits[np.repeat(begin, n) + (grams & np.repeat(width - 1, n).astype(np.uint64)).astype(np.int64)] = True
    data = np.packbits(bits).tobytes()
    return [data[a // 8:(a + w) // 8] for a, w in zip(begin.tolist(), width.tolist(), strict=True)]


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps of ``words`` 64-bit words from longer ones."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def _described(docs: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame:
    """One row per document: (id, at: the text's hash, n, class, tokens, bits, packed text)."""
    def run(batches):
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                column = batch.column(1).slice(lo, hi - lo)
                grams, ends = shingle_sets(column, k)
                n = np.diff(ends)
                total = np.add.reduceat(np.append(mix(grams), np.uint64(0)), ends[:-1])
                total[n == 0] = 0
                keys, offsets = sent_keys(grams, ends, percent)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(n, pa.int64()),
                    pa.array((total + n.astype(np.uint64)).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.view(np.int64))),
                    pa.array(bitmaps(grams, ends), pa.binary()),
                    pa.array([packer.compress((t or "").encode()) for t in column.to_pylist()], pa.binary()),
                ], names=["id", "at", "n", "class", "tokens", "bits", "packed"])

    return docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text"),
                       F.xxhash64(docs[text]).alias("at")).mapInArrow(
        run, "id bigint, at bigint, n bigint, class bigint, tokens array<bigint>, bits binary, packed binary")


def _stored(rows: DataFrame, name: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _some(rows: DataFrame, needed: DataFrame) -> DataFrame:
    """The rows whose class is in ``needed`` (one row a class), with its columns. Rows
    are long, so a bitmap of needed classes, as large for any input, first drops most
    others where they are read; only what passes is dealt out for the exact join (an
    inner one: a semi join would be moved below the bitmap's)."""
    bit = F.pmod(F.col("class"), F.lit(SKETCH_PARTS * SKETCH_BITS))
    part, at = F.floor(bit / SKETCH_BITS).cast("int"), F.pmod(bit, F.lit(SKETCH_BITS))
    sketch = needed.groupBy(part.alias("__part")).agg(F.bitmap_construct_agg(at).alias("__bits"))
    byte = F.conv(F.hex(F.substring("__bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return rows.join(F.broadcast(sketch), part == F.col("__part")) \
        .where(F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1) \
        .select(*rows.columns).join(needed, "class")


def _may_link(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose bitmaps (halved, they are sent for each pair) and sizes
    allow enough overlap."""
    def halve(batches):
        for batch in batches:
            bits = [np.frombuffer(v, dtype=np.uint64)[None] for v in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(
                [folded(v, max(v.shape[1] // 2, LEAST_BITS // 128)).tobytes() for v in bits], pa.binary())],
                names=["class", "n", "bits"])

    some = classes.select("class", "n", "bits").mapInArrow(halve, "class bigint, n bigint, bits binary")
    side = lambda s: some.select(F.col("class").alias(s), F.col("n").alias(f"{s}_n"), F.col("bits").alias(f"{s}_bits"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_n", "b_n", "a_bits", "b_bits")

    def run(batches):
        for batch in batches:
            ok = []
            for x, y, p, q in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
                p, q = (np.frombuffer(v, dtype=np.uint64)[None] for v in (p, q))
                p, q = folded(p, q.shape[1]), folded(q, p.shape[1])
                most = min(x - int(np.bitwise_count(p & ~q).sum()), y - int(np.bitwise_count(q & ~p).sum()))
                ok.append(most * (100 + percent) >= (x + y) * percent)
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


def _unpacked_sets(packed: dict, k: int) -> dict:
    """Sorted shingle hashes of classes from their packed texts."""
    unpacker, sets, keys = zstandard.ZstdDecompressor(), {}, list(packed)
    for lo in range(0, len(keys), 256):
        some = keys[lo:lo + 256]
        grams, ends = shingle_sets(pa.array([unpacker.decompress(packed[c]).decode() for c in some], pa.string()), k)
        sets |= {c: grams[ends[j]:ends[j + 1]] for j, c in enumerate(some)}
    return sets


def _linked(sets: dict, a: list, b: list, percent: int) -> list[bool]:
    ok = []
    for x, y in zip(a, b, strict=True):
        common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
        ok.append(100 * common >= percent * (len(sets[x]) + len(sets[y]) - common))
    return ok


def _verified(pairs: DataFrame, described: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose exact sets are linked."""
    near = _stored(pairs, "near")
    needed = near.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    texts = _stored(_some(described.select("class", "packed"), _stored(needed, "needed")).dropDuplicates(["class"]), "texts")
    side = lambda s: texts.select(F.col("class").alias(s), F.col("packed").alias(f"{s}_packed"))
    both = near.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_packed", "b_packed")

    def run(batches):
        for batch in batches:
            step = 256
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                a, b, *packed = (part.column(i).to_pylist() for i in range(4))
                sets = _unpacked_sets(dict(zip(a + b, packed[0] + packed[1], strict=True)), k)  # a class is unpacked once
                yield part.select([0, 1]).filter(pa.array(_linked(sets, a, b, percent), pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


class SignatureTree:
    """Rows sorted by size under levels of nodes of ``FANOUT`` children each:
    OR of the bitmaps, range of the sizes, largest surplus of a size over its
    bits, and the component if it is one."""

    def __init__(self, n: np.ndarray, bits: np.ndarray, comp: np.ndarray):
        surplus = n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [(bits, n, n, surplus, comp, np.ones(len(n), bool))]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, surplus, comp, one = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            self.levels.append((
                np.bitwise_or.reduceat(bits, at, axis=0), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                np.maximum.reduceat(surplus, at), np.minimum.reduceat(comp, at),
                np.logical_and.reduceat(one, at) & (np.minimum.reduceat(comp, at) == np.maximum.reduceat(comp, at))))

    def possible(self, other: SignatureTree, level: int, a: np.ndarray, b: np.ndarray,
                 percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Which node pairs of a level may hold a linked pair of two components,
        and the largest possible overlap of these as a share of their sizes."""
        bits, low, high, surplus, comp, one = self.levels[level]
        bits2, low2, high2, surplus2, comp2, one2 = other.levels[level]
        ok = (high[a] * 100 >= low2[b] * percent) & (high2[b] * 100 >= low[a] * percent)
        ok &= ~(one[a] & one2[b] & (comp[a] == comp2[b]))
        a, b = a[ok], b[ok]
        common = np.bitwise_count(bits[a] & bits2[b]).sum(axis=1, dtype=np.int64)
        most = np.minimum(np.minimum(surplus[a], surplus2[b]) + common, np.minimum(high[a], high2[b]))
        enough = most * (100 + percent) >= (low[a] + low2[b]) * percent
        ok[ok] = enough
        return ok, most[enough] / (low[a] + low2[b])[enough]

    def joined(self, other: SignatureTree, percent: int, chunk: int = 50_000):
        """Row pairs (of this tree, of the other) that may be linked, with the
        largest possible overlap as a share of both sizes."""
        same = other is self
        top = max(len(self.levels), len(other.levels)) - 1
        for tree in (self, other):  # equal heights: a single node is its own parent
            while len(tree.levels) <= top:
                tree.levels.append(tree.levels[-1])
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, a, b = stack.pop()
            if len(a) > chunk:
                stack += [(level, a[i:i + chunk], b[i:i + chunk]) for i in range(0, len(a), chunk)]
                continue
            if same:
                once = (a < b) if level == 0 else (a <= b)
                a, b = a[once], b[once]
            ok, share = self.possible(other, level, a, b, percent)
            a, b = a[ok], b[ok]
            if not len(a):
                continue
            if level == 0:
                yield a, b, share
                continue
            for part in np.array_split(np.arange(len(a)), 1 + len(a) * FANOUT**2 // (4 * chunk)):
                x, y = self._children(level, a[part]), other._children(level, b[part])
                i, j = np.broadcast_arrays(x[:, :, None], y[:, None, :])
                i, j = i.ravel(), j.ravel()
                own = (i >= 0) & (j >= 0)
                stack.append((level - 1, i[own], j[own]))

    def _children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        below = len(self.levels[level - 1][0])
        if below == len(self.levels[level][0]) == 1:
            return nodes[:, None]
        child = nodes[:, None] * FANOUT + np.arange(FANOUT)
        return np.where(child < below, child, -1)


class Forest:
    """Components of a group's rows while pairs are taken as links."""

    def __init__(self, labels: np.ndarray):
        self.node = np.unique(labels, return_inverse=True)[1]
        self.root = np.arange(int(self.node.max()) + 1)

    def take(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of pairs of rows that connect different components, one after
        the other; the components are merged."""
        taken, left = [], np.arange(len(a))
        while True:
            x, y = self.root[self.node[a[left]]], self.root[self.node[b[left]]]
            apart = x != y
            left, x, y = left[apart], x[apart], y[apart]
            if not len(left):
                return np.array(taken, dtype=np.int64)
            # the first pair of each component on the left, and of these the first of each on the right
            first = np.unique(x, return_index=True)[1]
            first = first[np.unique(y[first], return_index=True)[1]]
            for i in first.tolist():
                p, q = self.root[self.node[a[left[i]]]], self.root[self.node[b[left[i]]]]
                if p != q:
                    self.root[self.root == max(p, q)] = min(p, q)
                    taken.append(int(left[i]))


def _tree_pairs(rows: pa.Table, percent: int, forest: int) -> pa.Table:
    """Row pairs of one token group, or of one pair of its parts, that may be
    linked: all of them, or (``forest`` 1, 2, ...) a forest that would connect
    their components, first of the likeliest pairs and then of any."""
    rows = rows.combine_chunks()
    side = rows["side"].to_numpy()
    n, comp, classes = (rows[c].to_numpy() for c in ("n", "label", "class"))
    data = rows["bits"].combine_chunks()
    words = np.diff(np.frombuffer(data.buffers()[1], np.int32)[data.offset:data.offset + len(data) + 1]) // 8
    bits = data.to_pylist()
    whole = rows["i"][0].as_py() == rows["j"][0].as_py()
    sides = [side == rows[c][0].as_py() for c in ("i", "j")]
    found, merging = [], Forest(comp) if forest else None
    for w in np.unique(words).tolist():
        # sets whose sizes are near enough have bitmaps of equal or neighbouring lengths
        for x, y in ((w, w), (w, 2 * w)) if whole else ((w, w), (w, 2 * w), (2 * w, w)):
            own = []
            for s, width in ((0, x), (1, y)):
                at = np.flatnonzero(sides[s] & (words == width))
                own.append(at[np.lexsort((comp[at], n[at]))])
            if not len(own[0]) or not len(own[1]):
                continue
            trees = [SignatureTree(n[at], folded(np.frombuffer(b"".join([bits[i] for i in at]), np.uint64)
                                                 .reshape(len(at), -1), w), comp[at]) for at in own]
            if whole and x == y:
                trees[1] = trees[0]
            for a, b, share in trees[0].joined(trees[1], percent):
                a, b = own[0][a], own[1][b]
                if forest:
                    order = np.argsort(-share, kind="stable") if forest == 1 \
                        else np.random.default_rng(forest).permutation(len(a))
                    a, b = a[order], b[order]
                    taken = merging.take(a, b)
                    a, b = a[taken], b[taken]
                found.append((classes[a], classes[b]))
    a, b = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _blocks(rows: pa.Table, size: int, percent: int):
    """Parts of a task's rows for ``_tree_pairs``: the rows of its side or sides, sorted
    by size, in blocks of ``size``; each pair of blocks whose sizes fit, with the token
    and the blocks' numbers in the whole group."""
    token, *ij = (rows[c][0].as_py() for c in ("token", "i", "j"))
    sides = []
    for at in dict.fromkeys(ij):
        own = rows.filter(pc.equal(rows["side"], at)).sort_by([("n", "ascending"), ("class", "ascending")])
        sides.append([(at << 10 | k, own.slice(lo, size)) for k, lo in enumerate(range(0, own.num_rows, size))])
    for p, (i, a) in enumerate(sides[0]):
        for q, (j, b) in enumerate(sides[-1]):
            low, high = max(x["n"][0].as_py() for x in (a, b)), min(x["n"][-1].as_py() for x in (a, b))
            if len(sides) == 1 and q < p or high * 100 < low * percent:  # the block of smaller sets ends too early
                continue
            both = [(0, a)] if i == j else [(0, a), (1, b)]
            group = pa.concat_tables([x.set_column(x.column_names.index("side"), "side", pa.array([s] * len(x), pa.int32()))
                                      for s, x in both])
            for c, at in (("i", 0), ("j", len(both) - 1)):
                group = group.set_column(group.column_names.index(c), c, pa.array([at] * len(group), pa.int32()))
            yield token, i, j, group.combine_chunks()


def _first_met(rows: pa.Table, token: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether pairs of rows (places) have no common token below ``token``."""
    tokens = rows["tokens"].combine_chunks()
    flat, n = tokens.flatten().to_numpy(), np.diff(tokens.offsets.to_numpy())
    low = flat < token
    flat, row = flat[low], np.repeat(np.arange(len(n)), n)[low]
    _, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
    name = np.cumsum(count > 1) - 1
    shared = count[inverse] > 1
    row, bit = row[shared], name[inverse[shared]]
    width = 1 + (int(bit.max()) >> 3 if len(bit) else 0)
    bits = np.zeros((len(n), width), np.uint8)
    np.bitwise_or.at(bits, (row, bit >> 3), (1 << (bit & 7)).astype(np.uint8))
    step = max(1, (32 << 20) // width)
    return np.concatenate([np.zeros(0, bool)] + [~(bits[a[i:i + step]] & bits[b[i:i + step]]).any(axis=1)
                                                 for i in range(0, len(a), step)])


def _lists(of: np.ndarray, value: np.ndarray, keys: np.ndarray) -> pa.ListArray:
    """For each of the sorted ``keys`` the values whose ``of`` is this key."""
    order = np.argsort(of, kind="stable")
    ends = np.searchsorted(of[order], keys, side="right")
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(value[order], pa.int64()))


def _links_of_group(classes: np.ndarray, sets: list, others: list, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of classes (sorted) with their sets and the classes that each may link with, the
    places (a, b) of those that do."""
    n = np.array([len(s) for s in sets])
    token = np.unique(np.concatenate(sets), return_inverse=True)[1]
    begin, own = np.cumsum(n) - n, np.zeros(len(token), dtype=bool)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, some in enumerate(others):
        mine = token[begin[i]:begin[i] + n[i]]
        own[mine] = True
        at = np.searchsorted(classes, np.asarray(some, dtype=np.int64))
        for part in np.array_split(at, -(-len(at) // 512)) if len(at) else []:
            first = np.cumsum(n[part]) - n[part]
            place = np.arange(int(n[part].sum())) + np.repeat(begin[part] - first, n[part])
            common = np.add.reduceat(own[token[place]], first, dtype=np.int64)
            linked = part[100 * common >= percent * (n[i] + n[part] - common)]
            a.append(np.full(len(linked), i))
            b.append(linked)
        own[mine] = False
    return np.concatenate(a), np.concatenate(b)


def _met(classes: DataFrame, all_links: bool, percent: int = 75) -> DataFrame:
    """The keys that several classes send: (class, n, token, m: how many send it), or
    (place, class, token, leader: the smallest of them) for the components only. Most
    keys are sent once, so all of them are dealt by token once and not joined. Sets small
    enough to send single tokens meet by these, so neighbours that only such sets send
    are left out."""
    group = Window.partitionBy("token")
    tokens = classes.select("class", "n", F.posexplode("tokens").alias("place", "token"))
    met = tokens.select("*", F.min("class").over(group).alias("leader"), F.max("class").over(group).alias("last"),
                        F.max("n").over(group).alias("widest"),
                        *([F.count(F.lit(1)).over(group).alias("m")] if all_links else [])) \
        .where((F.col("leader") < F.col("last"))
               & ((F.pmod("token", F.lit(2)) == 0) | (F.col("widest") * percent > narrow(percent) * 100)))
    return met.select(*(["class", "n", "token", "m"] if all_links else ["place", "class", "token", "leader"]))


def _all_links(rows: DataFrame, classes: DataFrame, described: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """All links of classes that meet in token groups (class, n, token, m), each once:
    pairs (a, b), and rows (class, root, n_rows, others) of larger groups with the
    smallest class reached, the number of linked rows and the larger linked classes."""
    few = rows.where(F.col("m") <= PAIRED_ROWS).groupBy("token").agg(F.collect_list(F.struct("class", "n")).alias("all"))
    fit = lambda x, y: F.col(f"{x}.n") * 100 >= F.col(f"{y}.n") * percent
    few = few.select(F.explode("all").alias("a"), "all").select("a", F.explode("all").alias("b")) \
        .where((F.col("a.class") < F.col("b.class")) & fit("a", "b") & fit("b", "a")) \
        .select(F.col("a.class").alias("a"), F.col("b.class").alias("b")).distinct()
    few = _verified(_may_link(few, classes, percent), described, k, percent)

    big = rows.where(F.col("m") > PAIRED_ROWS)
    met = _stored(big.groupBy("class").agg(F.collect_list("token").alias("tokens")), "large")
    side = lambda s: met.select(F.col("class").alias(s), F.col("tokens").alias(f"{s}_tokens"))
    few = few.join(side("a"), "a", "left").join(side("b"), "b", "left") \
        .where(~F.coalesce(F.arrays_overlap("a_tokens", "b_tokens"), F.lit(False))).select("a", "b")

    parts = F.ceil(F.col("m") / (BLOCKS * GROUP_ROWS)).cast("int")
    split = big.withColumn("side", F.pmod(F.xxhash64("class"), parts).cast("int")) \
        .select("token", "class", "n", F.col("class").alias("label"), "side",
                F.explode(F.sequence(F.lit(0), parts - 1)).alias("with")) \
        .select("token", "class", "n", "label", "side", F.least("side", "with").alias("i"),
                F.greatest("side", "with").alias("j")) \
        .join(_some(classes.select("class", "bits"), met), "class")
    rows_of_block = GROUP_ROWS

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, i, j, group in _blocks(pa.Table.from_batches(batches), rows_of_block, percent):
            found = _tree_pairs(group, percent, 0)
            own = group["class"].to_numpy()
            order = np.argsort(own)
            a, b = (order[np.searchsorted(own, found[c].to_numpy(), sorter=order)] for c in ("a", "b"))
            found = found.filter(pa.array(_first_met(group, token, a, b)))
            a, b = found["a"].to_numpy(), found["b"].to_numpy()
            needed = np.unique(np.concatenate([a, b]))
            place = [pa.array([x] * len(needed), kind) for x, kind in ((token, pa.int64()), (i, pa.int32()), (j, pa.int32()))]
            yield pa.RecordBatch.from_arrays([*place, pa.array(needed), _lists(a, b, needed)],
                                             names=["token", "i", "j", "class", "others"])

    near = _stored(split.groupBy("token", "i", "j").applyInArrow(
        pairs, "token bigint, i int, j int, class bigint, others array<bigint>"), "near")
    texts = _some(described.select("class", "packed"), _stored(near.select("class").distinct(), "needed")) \
        .groupBy("class").agg(F.any_value("packed").alias("packed"), F.count(F.lit(1)).alias("m"))

    def verify(group: pa.Table) -> pa.Table:
        group = group.sort_by("class").combine_chunks()
        own, m = group["class"].to_numpy(), group["m"].to_numpy()
        sets = _unpacked_sets(dict(zip(own.tolist(), group["packed"].to_pylist(), strict=True)), k)
        a, b = _links_of_group(own, [sets[c] for c in own.tolist()], group["others"].to_pylist(), percent)
        root, before = np.arange(len(own)), None
        while before is None or (root != before).any():  # the smallest place that links reach
            before = root.copy()
            np.minimum.at(root, a, root[b])
            np.minimum.at(root, b, root[a])
            root = root[root]
        n_rows = np.bincount(a, weights=m[b], minlength=len(own)) + np.bincount(b, weights=m[a], minlength=len(own))
        out = pa.table([pa.array(own), pa.array(own[root]), pa.array(n_rows.astype(np.int64)),
                        _lists(own[a], own[b], own)], names=["class", "root", "n_rows", "others"])
        return out.filter(pa.array(n_rows > 0))

    many = near.join(texts, "class").groupBy("token", "i", "j").applyInArrow(
        verify, "class bigint, root bigint, n_rows bigint, others array<bigint>")
    return _stored(few, "links"), _stored(many, "lists")


def _between_components(rows: DataFrame, classes: DataFrame, links: DataFrame, percent: int,
                        forest: int) -> DataFrame:
    """Pairs (a, b) that may be linked, of token groups whose rows (place, class,
    token) lie in several components of ``links``. A forest is a shortcut, so it
    takes the groups of each class's first ``FOREST_TOKENS`` tokens only."""
    some = rows.where(F.col("place") < FOREST_TOKENS) if forest else rows
    labelled = some.join(components(links).withColumnRenamed("node", "class"), "class", "left") \
        .select("token", "class", F.coalesce("label", "class").alias("label"))
    open_ = labelled.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                          F.count(F.lit(1)).alias("m")).where("low < high").select("token", "m")
    parts = F.ceil(F.col("m") / GROUP_ROWS).cast("int")
    split = labelled.join(open_, "token").withColumn("side", F.pmod(F.xxhash64("class"), parts).cast("int")).select(
        "token", "class", "label", "side", F.explode(F.sequence(F.lit(0), parts - 1)).alias("with")) \
        .select("token", "class", "label", "side", F.least("side", "with").alias("i"),
                F.greatest("side", "with").alias("j")) \
        .join(classes.select("class", "n", "bits"), "class")
    return split.groupBy("token", "i", "j").applyInArrow(
        lambda group: _tree_pairs(group, percent, forest), "a bigint, b bigint").distinct()


def _connecting_links(rows: DataFrame, classes: DataFrame, described: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) that connect the components, of rows (place, class, token, leader)."""
    first = rows.where("class <> leader").select(F.col("leader").alias("a"), F.col("class").alias("b")).distinct()
    links = _stored(_verified(_may_link(first, classes, percent), described, k, percent), "links")
    for forest in [*range(1, FOREST_ROUNDS + 1), 0]:
        more = _between_components(rows, classes, links, percent, forest)
        links = _stored(links.union(_verified(more if forest else more.join(first, ["a", "b"], "left_anti"),
                                              described, k, percent)).distinct(), "links")
    return links


def near_duplicates(docs: DataFrame, percent: int = 75, k: int = 5, key: str = "doc_id",
                    text: str = "text", all_links: bool = True) -> tuple[DataFrame, DataFrame]:
    """(documents, links). Documents: one row per row of ``docs`` with ``id``,
    ``at`` (hash of the text), ``n_shingles``, ``class`` (equal sets share one), ``component_id``, the
    smallest key that links reach, and ``n_links``, the number of other rows that
    are linked with it (those of its class and of linked classes). Links: all
    verified links between classes (a < b). Without ``all_links`` the links are
    only as many as connect the components, and ``n_links`` is not given.

    Two sets are linked if ``100 * intersection >= percent * union``, both in
    whole numbers. A null or empty text, or one without words, has no shingles
    and is linked with nothing; its component is its own key. A null key gets
    its component's smallest key (null if it has none). Repeated rows each get
    their row. Other columns are not read. Empty tables give no rows.
    """
    described = _stored(_described(docs, key, text, k, percent), "described")
    classes = _stored(described.where("n > 0").select("class", "n", "tokens", "bits").dropDuplicates(["class"]), "classes")
    rows = _stored(_met(classes, all_links, percent), "met")
    if all_links:
        few, many = _all_links(rows, classes, described, k, percent)
        links = few.union(many.select("class", F.explode("others")))  # made only if it is read
        joined = few.union(many.select("root", "class"))
    else:
        joined = links = _connecting_links(rows, classes, described, k, percent)

    labels = components(joined).withColumnRenamed("node", "class")
    if all_links:
        size = described.where("n > 0").groupBy("class").agg(F.count(F.lit(1)).alias("m"))
        both = few.union(few.select("b", "a")).toDF("class", "other")
        linked = both.join(size.toDF("other", "rows"), "other").select("class", "rows") \
            .union(many.select("class", "n_rows")).groupBy("class").agg(F.sum("rows").alias("rows"))
        labels = size.join(linked, "class", "left").join(labels, "class", "left").select(
            "class", "label", (F.col("m") - 1 + F.coalesce("rows", F.lit(0))).alias("n_links"))
    member = described.select("id", "at", "n", "class").join(labels, "class", "left") \
        .withColumn("label", F.coalesce("label", "class"))
    least = member.where("n > 0").groupBy("label").agg(F.min("id").alias("component_id"))
    out = member.join(least, "label", "left").select(
        "id", "at", F.col("n").alias("n_shingles"), "class",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        *([F.when(F.col("n") > 0, F.col("n_links")).otherwise(F.lit(0)).alias("n_links")] if all_links else []))
    return out, links


def one_of_each(docs: DataFrame, percent: int = 75, k: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row for each component of near duplicates: that with the
    smallest key; of rows that repeat this key, the one with the smallest hashed
    text. Rows without shingles stay. A row with a null key stays unless it is
    linked with a row that has one. All columns stay as they are."""
    found, _ = near_duplicates(docs, percent, k, key, text, all_links=False)
    kept = materialize(found.where(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("id", "at").count())
    first = kept.where("id is not null").groupBy("id").agg(F.min("at").alias("at"))
    rows = first.unionByName(kept.where("id is null").select("id", "at")).toDF("__id", "__at")
    out = docs.withColumn("__text_at", F.xxhash64(text))
    out = out.join(rows, out[key].eqNullSafe(rows["__id"]) & (out["__text_at"] == rows["__at"]), "left_semi")
    if not kept.where("id is not null and count > 1").isEmpty():  # rows that repeat key and text
        turn = F.row_number().over(Window.partitionBy(key, "__text_at").orderBy(key))
        out = out.withColumn("__turn", turn).where(F.col(key).isNull() | (F.col("__turn") == 1)).drop("__turn")
    return out.drop("__text_at")
