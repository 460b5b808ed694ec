"""Fill-in-the-middle texts (operator 11), cut by a compressed boundary set.

The unit ends of a block of texts are one set of code-point places, kept the
roaring way: places are dealt by their upper bits into containers of 65,536,
each an array (few places), a bitmap (many) or runs (consecutive places),
whichever is smallest. Cumulative cardinalities over the containers turn the
search for the k-th boundary into a container search plus a local select, which
gives both cuts of every text at once.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.llm.words import buffers, slices

MARKS = ("<P>", "<S>", "<M>")
SLICE_BYTES = 2 << 20
_SPAN = 1 << 16
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1)


class _Array:
    """Sorted low bits: 2 bytes a place."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: np.ndarray) -> np.ndarray:
        return self.low[k].astype(np.int64)


class _Bitmap:
    """One bit for each of the 65,536 places, with the ones before each byte."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(_SPAN, dtype=np.uint8)
        bits[low] = 1
        self.bytes = np.packbits(bits)
        ones = _ONES[self.bytes]
        self.before = np.cumsum(ones) - ones

    def select(self, k: np.ndarray) -> np.ndarray:
        byte = np.searchsorted(self.before, k, side="right") - 1
        seen = np.cumsum(np.unpackbits(self.bytes[byte][:, None], axis=1), axis=1)
        return byte * 8 + (seen <= (k - self.before[byte])[:, None]).sum(axis=1)


class _Runs:
    """First places and lengths of runs of consecutive places: 4 bytes a run."""

    def __init__(self, low: np.ndarray, heads: np.ndarray):
        self.first = low[heads].astype(np.uint16)
        self.before = heads

    def select(self, k: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.before, k, side="right") - 1
        return self.first[run].astype(np.int64) + (k - self.before[run])


def _container(low: np.ndarray):
    heads = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    sizes = {_Runs: 4 * len(heads), _Array: 2 * len(low), _Bitmap: _SPAN // 8}
    kind = min(sizes, key=sizes.get)
    return _Runs(low, heads) if kind is _Runs else kind(low)


class BoundarySet:
    """A sorted set of places from 0; ``select(k)`` gives the k-th (from 0)."""

    def __init__(self, places: np.ndarray):
        upper, first, count = np.unique(places >> 16, return_index=True, return_counts=True)
        self.upper, self.before = upper << 16, first
        self.containers = [_container(places[a:a + n] & (_SPAN - 1))
                           for a, n in zip(first.tolist(), count.tolist(), strict=True)]

    def select(self, k: np.ndarray) -> np.ndarray:
        out = np.empty(len(k), dtype=np.int64)
        at = np.searchsorted(self.before, k, side="right") - 1
        for c in np.unique(at).tolist():
            here = at == c
            out[here] = self.upper[c] + self.containers[c].select(k[here] - self.before[c])
        return out


def _cuts(column: pa.Array, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(units, first cut, second cut) of each row in code points; ``draws`` are
    two columns of unsigned integers, taken modulo units + 1."""
    flat, ends = buffers(column)
    letters = np.concatenate([[0], np.cumsum((flat & 0xC0) != 0x80)])  # code points before each byte
    edge = letters[ends]
    line = np.flatnonzero(flat == 10) + 1
    closing = ends[1:][np.diff(ends) > 0]
    unit_end = np.unique(np.concatenate([line, closing]))  # a text's end closes its last unit
    before = np.searchsorted(unit_end, ends, side="right")
    n = np.diff(before)
    places = BoundarySet(letters[unit_end])
    take = np.sort(draws % (n + 1)[:, None], axis=1)
    cuts = []
    for m in (take[:, 0], take[:, 1]):
        cut = np.zeros(len(n), dtype=np.int64)
        some = m > 0
        cut[some] = places.select((before[:-1] + m - 1)[some]) - edge[:-1][some]
        cuts.append(cut)
    return n, cuts[0], cuts[1]


def _check(marks) -> None:
    """Marks must be told apart wherever they stand: no mark may hold another,
    and no end of a mark may begin one."""
    for a, b in itertools.product(marks, marks):
        if not a or len(set(marks)) < len(marks) or any(a.endswith(b[:i]) for i in range(1, len(b))) or (a != b and a in b):
            raise ValueError("marks must differ and not be empty, overlap or hold each other")


def _draw(key: Column, seed: str, group: int) -> Column:
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 8 * group + 1, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: str = "7", percent: int = 100,
                   spm_percent: int = 50, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """Cut every whole text into prefix, middle and suffix at line ends and write
    it in the order that a model learns to fill the middle from.

    A unit is a line with its line end (the last may lack one). Draws come from
    the SHA-256 of ``seed:key`` alone, so any rerun gives the same rows: two cuts
    among the units, ``percent`` of the texts transformed, ``spm_percent`` of
    these with the suffix first. Returns the key, ``n`` (units), ``form`` (plain,
    psm or spm), ``prefix_chars`` and ``middle_chars`` (code points, null where
    plain) and ``output``. One pass without a shuffle.

    Null and empty texts, and texts that hold a mark, stay plain (a null text is
    empty). A null key draws as an empty one; repeated rows give equal rows; only
    key and text are read, so other columns can't clash; an empty table gives no
    rows. A very long text is held alone.
    """
    _check(marks)
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    names = [key, "n", "form", "prefix_chars", "middle_chars", "output"]
    p, s, m = marks

    def run(batches):
        for batch in batches:
            draws = np.stack([batch.column(2 + i).to_numpy(zero_copy_only=False) for i in range(4)], axis=1)
            for lo, hi in slices(batch.column(1), SLICE_BYTES):
                column = batch.column(1).slice(lo, hi - lo)
                n, first, second = _cuts(column, draws[lo:hi, :2])
                forms, outputs = [], []
                for t, a, b, h3, h4 in zip(column.to_pylist(), first.tolist(), second.tolist(),
                                           *draws[lo:hi, 2:].T.tolist(), strict=True):
                    t = t or ""
                    if not t or h3 % 100 >= percent or any(mark in t for mark in marks):
                        forms.append("plain")
                        outputs.append(t)
                    elif h4 % 100 < spm_percent:
                        forms.append("spm")
                        outputs.append("".join((s, t[b:], p, t[:a], m, t[a:b])))
                    else:
                        forms.append("psm")
                        outputs.append("".join((p, t[:a], s, t[b:], m, t[a:b])))
                plain = np.array([f == "plain" for f in forms], dtype=bool)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(forms, pa.string()),
                     pa.array(first, pa.int64(), mask=plain), pa.array(second - first, pa.int64(), mask=plain),
                     pa.array(outputs, pa.string())], names=names)

    return docs.select(docs[key], docs[text].alias("__text"),
                       *[_draw(docs[key], seed, i).alias(f"__h{i + 1}") for i in range(4)]).mapInArrow(run, schema)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``output`` was written from (its marks stand once each)."""
    _check(marks)
    pattern = "|".join("\\Q" + mark + "\\E" for mark in marks)
    parts = F.split(output, pattern, -1)
    order = {"psm": (1, 3, 2), "spm": (2, 3, 1)}  # places of prefix, middle and suffix among the parts
    out = F.when(form == "plain", output)
    for name, places in order.items():
        out = out.when(form == name, F.concat(*[F.get(parts, F.lit(i)) for i in places]))
    return out
