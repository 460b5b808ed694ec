"""Approximate nearest neighbours (operator 3): vantage-point trees per shard.

Largest inner product becomes smallest distance with one more coordinate: with
M the largest norm of some vectors, x gets sqrt(M^2 - |x|^2) and a query gets 0.
Divided by M and, for the query, by its own norm, all lie on the unit sphere and
distance^2 = 2 - 2 q.x / (M |q|), so neither scale moves the distances.

Each shard is split into bands of norms, the largest first. A band of more than
``LEAF`` vectors has norms of at most ``BAND`` : 1, so its own M lifts no vector
far from the rest, and one long vector changes only its own band. A band has one
tree: a node keeps a vantage point and the median distance to it; points within
the median go left, the others right. A search with current k-th distance t skips
the left side if d - f*t > median and the right side if d + f*t < median, and a
band whose M |q| is below the k-th product. With f = 1 that is the triangle
inequality and the search is exact; a smaller f prunes more and may miss
neighbours. For ``TRIED`` queries of a block the shard's exact answer is computed;
if the smaller f finds less than ``LEAST_RECALL`` of it, the block takes f = 1.

Equal vectors are one entry of the index with their k + 1 smallest ids (no
query can need more), so a vector that a third of the rows share costs no more
than another.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS, BLOCK_QUERIES, LEAF = 8_192, 1_024, 256
BAND, TRIED, LEAST_RECALL = 1.1, 64, 0.95
SLACK = 1e-7  # of distances on the unit sphere, for rounding
TIED, MOST_PLACES = 1e-12, 1 << 19  # of products of norms up to 1; places held before a cut


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v: array<double>) of the vectors that take part: with an id, not
    null or empty, all components finite and not null, not all zero."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(key).cast("long").alias("id"), v.alias("v")) \
        .where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


class Tree:
    """A vantage-point tree in flat arrays over points in tree order."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, seed: int = 0):
        self.order = np.arange(len(points))
        self.nodes: list[tuple[int, int, int, float, int, int]] = []  # begin, end, vantage, median, left, right
        self.points, self.leaf = points, leaf
        self.rng = np.random.default_rng(seed)
        if len(points):
            self._build(0, len(points))
        self.points = points[self.order]

    def _build(self, begin: int, end: int) -> int:
        at = len(self.nodes)
        self.nodes.append((begin, end, -1, 0.0, -1, -1))
        if end - begin > self.leaf:
            own = self.order[begin:end]
            vantage = int(own[self.rng.integers(len(own))])
            d = distances(self.points[vantage][None], self.points[own])[0]
            cut = (end - begin) // 2
            by = np.argpartition(d, cut)
            self.order[begin:end] = own[by]
            median = float(d[by[:cut]].max())
            left = self._build(begin, begin + cut)
            right = self._build(begin + cut, end)
            self.nodes[at] = (begin, end, vantage, median, left, right)
        return at


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def lengths(points: np.ndarray) -> np.ndarray:
    """Norms of vectors that are not all zero, without over- or underflow of squares."""
    most = np.abs(points).max(axis=1, initial=0)
    return most * np.sqrt(((points / most[:, None])**2).sum(axis=1))


def bands(norms: np.ndarray) -> list[np.ndarray]:
    """Places of vectors by norm, the largest first, cut where a band has ``LEAF``
    or more and the next norm is below 1 / ``BAND`` of its largest."""
    order = np.argsort(-norms, kind="stable")
    falling, out, begin = norms[order], [], 0
    while begin < len(order):
        near = int(np.searchsorted(-falling, -falling[begin] / BAND, side="right"))
        end = min(max(near, begin + LEAF), len(order))
        out.append(order[begin:end])
        begin = end
    return out


class Band:
    """A tree over vectors of similar norms (``points``, at ``places`` of the shard)."""

    def __init__(self, points: np.ndarray, norms: np.ndarray, places: np.ndarray, seed: int):
        self.largest = max(float(norms.max()), np.finfo(float).tiny)
        unit = points / self.largest
        lift = np.sqrt(np.maximum(1 - (unit**2).sum(1), 0))
        lifted = np.hstack([unit, lift[:, None]])
        tree = Tree(lifted, seed=seed)
        vantage = sorted({n[2] for n in tree.nodes if n[2] >= 0})
        renamed = {v: i for i, v in enumerate(vantage)}
        self.nodes = [(*n[:2], renamed.get(n[2], -1), *n[3:]) for n in tree.nodes]
        self.vantages = lifted[vantage]
        self.points, self.places = points[tree.order], places[tree.order]


class Search:
    """The k vectors with the largest products of a shard's bands for a block of
    queries of norm 1, all at once. ``best`` holds products; ``found`` (rows,
    places) also every vector whose product is within rounding of the k-th, cut
    by ``cut`` when there are many."""

    def __init__(self, some: list[Band], queries: np.ndarray, k: int, factor: float, cut=None):
        self.q, self.k, self.factor, self.cut = queries, k, factor, cut
        self.best = np.full((len(queries), k), -np.inf)
        self.found = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.visited, self.parts, self.held, self.limit = 0, [], 0, MOST_PLACES
        for band in some:
            self.band = band
            rows = np.flatnonzero(self.best.min(axis=1) <= band.largest * (1 + SLACK))
            if len(band.vantages):
                lifted = np.hstack([queries, np.zeros((len(queries), 1))])
                self.vantage_distance = distances(lifted, band.vantages)
            self._visit(0, rows)
        if cut:
            self._cut()

    def _cut(self):
        rows, places, score = (np.concatenate([f[i] for f in self.parts] or [np.zeros(0, np.int64)]) for i in range(3))
        near = score >= self.best.min(axis=1)[rows] - TIED
        at = np.flatnonzero(near)[self.cut(rows[near], places[near])]
        self.found, self.parts, self.held = (rows[at], places[at]), [(rows[at], places[at], score[at])], len(at)
        self.limit = self.held + MOST_PLACES

    def _visit(self, node: int, rows: np.ndarray):
        begin, end, vantage, median, left, right = self.band.nodes[node]
        if not len(rows):
            return
        if vantage < 0:
            self.visited += len(rows) * (end - begin)
            score = self.q[rows] @ self.band.points[begin:end].T
            both = np.concatenate([self.best[rows], score], axis=1)
            self.best[rows] = -np.partition(-both, self.k - 1, axis=1)[:, :self.k]
            if self.cut:
                i, j = np.nonzero(score >= self.best[rows].min(axis=1)[:, None] - TIED)
                self.parts.append((rows[i], self.band.places[begin + j], score[i, j]))
                self.held += len(i)
                if self.held > self.limit:
                    self._cut()
            return
        d = self.vantage_distance[:, vantage]
        inner = d[rows] <= median
        for side in (True, False):  # each query first takes its own side, then, with a smaller radius, the other
            near = rows[inner == side]
            self._visit(left if side else right, near)
            share = np.minimum(self.best[near].min(axis=1) / self.band.largest, 1)
            radius = self.factor * np.sqrt(2 - 2 * share) + SLACK
            reach = d[near] - radius <= median if not side else d[near] + radius >= median
            self._visit(right if side else left, near[reach])


def held_factor(some: list[Band], points: np.ndarray, queries: np.ndarray, k: int, factor: float) -> float:
    """``factor`` if it finds ``LEAST_RECALL`` of the exact answer of ``TRIED`` queries, else 1."""
    if factor >= 1 or len(points) <= k or not len(queries):
        return factor
    tried = queries[np.linspace(0, len(queries) - 1, min(TRIED, len(queries))).astype(int)]
    kth = np.partition(tried @ points.T, len(points) - k, axis=1)[:, len(points) - k]
    got = Search(some, tried, k, factor).best >= kth[:, None] - 1e-12
    return factor if got.mean() >= LEAST_RECALL else 1.0


def search_shard(points: np.ndarray, ids: list[np.ndarray], queries: np.ndarray, query_ids: np.ndarray, k: int,
                 factor: float, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, inner product) of the k best ids of each query in a shard."""
    norms = lengths(points)
    largest = norms.max(initial=0)
    scaled = points / largest if largest else points
    some = [Band(scaled[at], norms[at] / largest, at, seed) for at in bands(norms)]
    unit = queries / lengths(queries)[:, None]
    least = np.array([own.min() for own in ids])
    most = min(k + 1, max(1, len(points)))  # an entry may hold the query itself

    def exact(rows, places):
        step = 1 << 16  # the same order of sums for every pair
        return np.concatenate([np.zeros(0)] + [(points[places[i:i + step]] * queries[rows[i:i + step]]).sum(axis=1)
                                               for i in range(0, len(rows), step)])

    def cut(rows, places):
        """The first ``most`` of each row by exact product, then smallest id."""
        order = np.lexsort((least[places], -exact(rows, places), rows))
        by = rows[order]
        return order[np.arange(len(by)) - np.searchsorted(by, by) < most]

    rows, entry = Search(some, unit, most, held_factor(some, scaled, unit, most, factor), cut).found
    ends = np.searchsorted(rows, np.arange(len(queries) + 1))  # the last cut left them by row
    out_q, out_id, out_score = [], [], []
    for i in range(len(queries)):
        entries = entry[ends[i]:ends[i + 1]]
        score = (points[entries] * queries[i]).sum(axis=1)  # the same order of sums for every pair
        own = [ids[e] for e in entries.tolist()]
        flat = np.concatenate(own) if own else np.zeros(0, np.int64)
        score = np.repeat(score, list(map(len, own)))
        other = flat != query_ids[i]
        flat, score = flat[other], score[other]
        top = np.lexsort((flat, -score))[:k]
        out_q.append(np.full(len(top), query_ids[i]))
        out_id.append(flat[top])
        out_score.append(score[top])
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return join(out_q, np.int64), join(out_id, np.int64), join(out_score, np.float64)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, factor: float = 1.0, key: str = "vec_id",
            vector: str = "embedding", shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """For each query row the ``k`` ids with the largest inner product among all
    rows of ``vectors`` with another id: (query_id, rank from 1, vec_id, score),
    ties to the smaller id; fewer rows if there are fewer candidates.

    Every usable vector is indexed; null, empty or zero vectors, vectors with a
    null or non-finite component or another length than the rest's most common
    one, and rows with a null id take no part, neither as query nor as
    candidate. Rows that repeat an id and vector count once; an id with several
    vectors is found with its best one, and as a query with each of them once
    (equal ids give one list). Empty tables give no rows. Other columns are not
    read. Blocks of queries meet every shard; only the ``k`` best of each shard
    are shuffled.
    """
    spark = vectors.sparkSession
    base = usable(vectors, key, vector)
    stats = base.agg(F.mode(F.size("v"), True).alias("dim"), F.count(F.lit(1)).alias("n")).first()
    asked = usable(queries, key, vector).where(F.size("v") == F.lit(stats["dim"] or 0)).distinct()
    base = base.where(F.size("v") == F.lit(stats["dim"] or 0)).distinct()
    n_queries = asked.count()
    shards = max(1, -(-stats["n"] // shard_rows))
    blocks = max(1, -(-n_queries // block_queries))
    # an entry is a vector with its k + 1 smallest ids
    first = Window.partitionBy("v").orderBy("id")
    entries = base.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1) \
        .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    packed = lambda rows, by, n, more: rows.groupBy(F.pmod(F.xxhash64(*by), F.lit(n)).cast("int").alias("part")).agg(
        F.collect_list(F.struct(*more)).alias("rows"))
    index = packed(entries, ["v"], shards, ["ids", "v"]).withColumnRenamed("part", "shard")
    asked = packed(asked, ["id"], blocks, ["id", "v"]) \
        .select("part", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                F.col("rows").alias("queries"))
    pairs = asked.join(index, "shard").select("shard", "queries", "rows") \
        .repartition(max(1, shards * blocks), "shard", F.col("queries")[0]["id"])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                qs, rows = batch.column(1)[i].values, batch.column(2)[i].values
                q_ids, q = qs.field("id").to_numpy(), _matrix(qs.field("v"))
                ids = rows.field("ids")
                ends = ids.offsets.to_numpy() - ids.offsets[0].as_py()
                groups = np.split(ids.flatten().to_numpy(), ends[1:-1])
                got = search_shard(_matrix(rows.field("v")), groups, q, q_ids, k, factor,
                                   seed=batch.column(0)[i].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in got], names=["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(run, "query_id bigint, vec_id bigint, score double")
    by_id = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return by_id.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    flat = vectors.flatten().to_numpy()
    return flat.reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 1))
