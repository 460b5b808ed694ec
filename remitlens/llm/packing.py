"""Best-fit packing (operator 6) by the sum-of-squares rule.

Pieces are dealt evenly over packing groups of bounded size. Inside a group,
largest first, each piece goes where the sum over all residual gaps of the
squared number of open sequences with that gap becomes smallest (a new sequence
is one of the choices). That keeps many different gaps open, so later pieces
find exact fits. The sequences that still have a gap at the end are taken apart
and packed once more into the tightest gap, largest first; the better of the
two results stays.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.llm.bpe import id_pieces
from remitlens.session import materialize

GROUP_PIECES = 32_768
GAP_CLASSES = 256  # gaps of one token each are nearly all held once or not at all, so their squares tell little


def sum_of_squares(lengths: np.ndarray, size: int, order: np.ndarray, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(sequence of each piece, gap of each sequence), taking the pieces in
    ``order``. Open sequences are counted by gap in classes of ``width`` tokens;
    among moves between the same classes the tightest gap is taken."""
    gap_class = np.arange(size + 1) // width
    count = np.zeros(int(gap_class[-1]) + 1, dtype=np.int64)
    held = np.zeros(size + 1, dtype=bool)
    open_: list[list[int]] = [[] for _ in range(size + 1)]
    gap: list[int] = []
    out = np.empty(len(lengths), dtype=np.int64)
    never = np.int64(1) << 60

    def opened(g: int, b: int):
        count[gap_class[g]] += 1
        held[g] = True
        open_[g].append(b)

    for i in order.tolist():
        s = int(lengths[i])
        if s < size:
            # from gap g to g - s: the squares of both classes' counts change; a filled sequence is no longer open
            of, to = gap_class[s:size], gap_class[:size - s]
            change = np.where(of == to, 0, 2 * (count[to] - count[of]) + 2)
            change[0] = 1 - 2 * count[of[0]]
            change[~held[s:size]] = never
            left = int(change.argmin())
            if change[left] <= 2 * count[gap_class[size - s]] + 1:
                g = s + left
                out[i] = b = open_[g].pop()
                count[gap_class[g]] -= 1
                held[g] = bool(open_[g])
                gap[b] = left
                if left:
                    opened(left, b)
                continue
            opened(size - s, len(gap))
        out[i] = len(gap)
        gap.append(size - s)
    return out, np.array(gap, dtype=np.int64)


def tightest_gap(lengths: np.ndarray, size: int, order: np.ndarray) -> np.ndarray:
    """The sequence of each piece by plain best fit, in ``order``."""
    open_: list[list[int]] = [[] for _ in range(size + 1)]
    filled = np.zeros(size + 1, dtype=bool)
    out, n = np.empty(len(lengths), dtype=np.int64), 0
    for i in order.tolist():
        s = int(lengths[i])
        fit = s + int(filled[s:].argmax())
        if filled[fit]:
            b = open_[fit].pop()
            filled[fit] = bool(open_[fit])
        else:
            b, fit, n = n, size, n + 1
        if fit > s:
            open_[fit - s].append(b)
            filled[fit - s] = True
        out[i] = b
    return out


def pack(lengths: np.ndarray, size: int) -> np.ndarray:
    """The sequence (0, 1, ...) of each piece of 1 to ``size`` tokens."""
    order = np.argsort(-lengths, kind="stable")
    out, gap = sum_of_squares(lengths, size, order, max(1, size // GAP_CLASSES))
    loose = gap[out] > 0
    if loose.any():
        again = tightest_gap(lengths, size, order_of := np.flatnonzero(loose)[np.argsort(-lengths[loose], kind="stable")])
        if int(again[order_of].max()) + 1 < int((gap > 0).sum()):
            out[loose] = len(gap) + again[loose]
    return np.unique(out, return_inverse=True)[1]


def pack_pieces(pieces: DataFrame, size: int, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (with a column ``length`` of 1 to ``size``) with ``sequence_id``
    and ``offset``: no sequence holds more than ``size`` tokens, and its pieces
    lie in it without gaps from 0.

    Pieces are stored once, then numbered and dealt in turn over groups of about
    ``group_pieces``, so copies and hot keys spread evenly and a task holds one
    group. Lengths outside 1 to ``size`` or null raise an error. An empty table
    gives no rows.
    """
    stored = materialize(pieces)
    groups = max(1, -(-stored.count() // group_pieces))
    # the number's upper bits are the partition: spread both parts
    number = F.monotonically_increasing_id()
    numbered = stored.withColumn("__group", F.pmod(number + F.shiftright(number, 33), F.lit(groups)).cast("int"))

    def one(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["length"].to_numpy()
        if not ((lengths >= 1) & (lengths <= size)).all():
            raise ValueError(f"a piece's length must be 1 to {size}")
        place = pack(lengths.astype(np.int64), size)
        rows = rows.drop(columns="__group")
        rows["sequence_id"] = place + (int(group[0]) << 32)
        by = np.argsort(place, kind="stable")
        before = np.cumsum(lengths[by]) - lengths[by]
        first = np.flatnonzero(np.diff(place[by], prepend=-1))
        offset = np.empty(len(rows), dtype=np.int64)
        offset[by] = before - np.repeat(before[first], np.diff(np.append(first, len(by))))
        rows["offset"] = offset
        return rows

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema.fields)
    return numbered.groupBy("__group").applyInPandas(one, schema + ", sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, path: str, size: int = 2048, end_id: int = 0, text: str = "text",
                   key: str = "doc_id") -> DataFrame:
    """Encode every whole text with the word vocabulary at ``path``, end it with
    ``end_id``, cut it into pieces of ``size`` and pack the pieces into as few
    sequences as the rule finds: (key, piece, start, length, ids_crc32,
    sequence_id, offset).

    A null or empty text is one piece of the end id. Repeated rows are packed
    each, null keys too; other columns are not read.
    """
    return pack_pieces(id_pieces(docs, path, size, end_id, text, key), size)
