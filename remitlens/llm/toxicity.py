"""Toxicity (operator 9): compression distance under two zstandard dictionaries.

One dictionary is trained on toxic and one on ordinary labelled text. A text is
cut into windows of words; a window that shortens more under the toxic
dictionary speaks for toxic. A logistic calibration on other labelled texts
turns the differences of a text's windows into a score.

A word enters the windows as codes of four bytes for itself and for its first
bytes (stems), and a code that neither dictionary holds as zeros. So a match is
a word or a stem, not a chance piece of one, and a language's usual syllables
weigh nothing. The dictionaries hold codes: the toxic one those that labelled
toxic texts hold far more often, the ordinary one the most frequent others.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.llm.words import Words, slices

PREFIXES, WINDOW_WORDS, LEVEL = (4, 6, 7), 32, 9
MOST_LABELLED = 2_000  # labelled texts of each class that training reads at most
TELLING, COMMON = 4.0, 600  # deviations that make a code toxic; number of ordinary codes


def codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(codes: one row of four per word, word places where each row begins)."""
    words = Words(column, fold_case=True, letters_only=True, prefixes=PREFIXES)
    hashes = np.stack([*words.prefix_hash, words.hash], axis=1)
    return (hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1), words.rows


def _compressor(dictionary: np.ndarray) -> zstandard.ZstdCompressor:
    made = zstandard.ZstdCompressionDict(dictionary.tobytes(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    made.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_content_size=False, write_checksum=False,
                                    write_dict_id=False)


@dataclass
class Model:
    toxic: np.ndarray
    ordinary: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray

    def features(self, column: pa.Array) -> np.ndarray:
        """What the length differences of each text's windows say."""
        known = np.unique(np.concatenate([self.toxic, self.ordinary]))
        filler = self.ordinary[:len(self.toxic)]  # both dictionaries are equally long
        plain = _compressor(np.concatenate([filler, self.ordinary]))
        toxic = _compressor(np.concatenate([self.toxic, self.ordinary]))
        out = np.zeros((len(column), 5))
        for lo, hi in slices(column):
            code, rows = codes(column.slice(lo, hi - lo))
            if len(known):
                code = np.where(known[np.minimum(np.searchsorted(known, code), len(known) - 1)] == code, code, 0)
            width = code.shape[1] * 4
            data = code.astype("<u4").tobytes()
            for i, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True)):
                n = max(1, b - a)
                less = []
                for w in range(a, b, WINDOW_WORDS):
                    window = data[w * width:min(b, w + WINDOW_WORDS) * width]
                    less.append(len(plain.compress(window)) - len(toxic.compress(window)))
                d = np.array(less or [0], dtype=np.float64)
                out[lo + i] = (d.sum() / n, np.log1p(n), d.sum() / n**0.5, (d > 2).mean(), np.sort(d)[-3:].mean())
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        x = (self.features(column) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weight[:-1] + self.weight[-1], -30, 30)))


def _dictionaries(toxic: pa.Array, ordinary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    held = []
    for column in (toxic, ordinary):
        parts = []
        for lo, hi in slices(column):
            code, rows = codes(column.slice(lo, hi - lo))
            row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
            both = np.unique((np.repeat(row, code.shape[1]).astype(np.uint64) << np.uint64(32)) | code.ravel())
            parts.append((both & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        held.append(np.unique(np.concatenate(parts or [np.zeros(0, np.uint32)]), return_counts=True))
    every = np.union1d(held[0][0], held[1][0])
    count = np.zeros((2, len(every)))
    for side, (code, n) in enumerate(held):
        count[side, np.searchsorted(every, code)] = n
    n = np.array([max(1, len(toxic)), max(1, len(ordinary))], dtype=np.float64)
    share = count.sum(0) / n.sum()
    far = (count[0] / n[0] - count[1] / n[1]) / np.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]) + 1e-12)
    telling = (far > TELLING) & (count[0] >= 3)
    common = np.flatnonzero(~telling)
    common = common[np.argsort(count[1][common], kind="stable")][-COMMON:]
    telling = np.flatnonzero(telling)
    return every[telling[np.argsort(far[telling], kind="stable")]], every[common]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + 1e-2 * np.append(w[:-1], 0)
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(curve, slope)
    return w


def train(texts: list[str | None], toxic: list[bool], totals: tuple[int, int]) -> Model:
    """Dictionaries from every other labelled text of each class, calibration on
    the rest; ``totals`` are the numbers of all toxic and ordinary labelled
    texts, which the sample stands for. Without texts of both classes the score
    is the share of toxic ones (0 without any)."""
    toxic = np.array(toxic, dtype=bool)
    order = np.concatenate([np.flatnonzero(toxic), np.flatnonzero(~toxic)])
    texts = pa.array([texts[i] for i in order], pa.string())
    n = int(toxic.sum())
    place = np.arange(len(order))
    own = np.concatenate([np.arange(n), np.arange(len(order) - n)]) % 2 == 0
    is_toxic = place < n
    model = Model(*_dictionaries(texts.filter(pa.array(own & is_toxic)), texts.filter(pa.array(own & ~is_toxic))),
                  np.zeros(5), np.ones(5), np.zeros(6))
    rest = np.flatnonzero(~own)
    share = totals[0] / max(1, sum(totals))
    model.weight[-1] = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
    if 0 < is_toxic[rest].sum() < len(rest):
        x, y = model.features(texts.take(pa.array(rest))), is_toxic[rest]
        model.mean, model.scale = x.mean(0), x.std(0) + 1e-9
        weight = np.where(y, totals[0] / y.sum(), totals[1] / (~y).sum()) * len(y) / sum(totals)
        model.weight = _logistic((x - model.mean) / model.scale, y.astype(float), weight)
    return model


def held_out(key: Column) -> Column:
    """Whether a document's label is kept from training."""
    return F.crc32(key.cast("string").cast("binary")) % 4 == 2


def fitted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
           most: int = MOST_LABELLED) -> Model:
    """The model from at most ``most`` labelled texts of each class (those with
    the smallest hashed keys), none of them held out. Rows with a null key or
    label are no labels; a key with several labels counts as toxic if one is."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key) \
        .agg((F.max(F.col(label).cast("int")) > 0).alias("is_toxic")).where(~held_out(F.col(key)))
    counts = {r["is_toxic"]: r["count"] for r in known.groupBy("is_toxic").count().collect()}
    chosen = None
    for side in (True, False):
        some = known.where(F.col("is_toxic") == side).orderBy(F.xxhash64(key), key).limit(most)
        chosen = some if chosen is None else chosen.unionByName(some)
    # at most 2 * most keys: safe to broadcast
    rows = docs.select(F.col(key), F.col(text).alias("__text")).join(F.broadcast(chosen), key) \
        .select(F.col(key).alias("id"), "__text", "is_toxic").dropDuplicates(["id"]).orderBy("id").collect()
    return train([r["__text"] for r in rows], [r["is_toxic"] for r in rows],
                 (counts.get(True, 0), counts.get(False, 0)))


def scored(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on)
    of every whole text, in one pass without a shuffle. A null or empty text, or
    one without letters, has windows without a difference and gets the
    calibrated score of that. Repeated rows and null keys are scored like
    others; other columns stay (``score`` and ``predicted`` are replaced)."""
    docs = docs.drop("score", "predicted")
    place = docs.columns.index(text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(place)):
                part = batch.slice(lo, hi - lo)
                score = model.score(part.column(place))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                    names=[*part.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, schema + ", score double, predicted int")
