"""Words and shingles of Arrow text columns, hashed with numpy.

A word is a maximal run of bytes other than space and ``\\x09``-``\\x0D``. All
functions work on the flat UTF-8 buffer of a slice of rows, so no Python
object per word is made. Hashes are 64 bits and depend on the bytes alone
(the same in every process). A word's hash sums mixed products of its bytes and
their places; the mixing keeps sums of one kind from cancelling out, as they do
in polynomials modulo 2^64. ``check`` is a second, independent hash of each word
by which caches tell words of equal hash apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_M1, _M2 = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)
_BASE, _CHECK = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)
_SPACES = (9, 10, 11, 12, 13, 32)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    h = h ^ (h >> U64(33))
    h = h * _M1
    h = h ^ (h >> U64(33))
    h = h * _M2
    return h ^ (h >> U64(33))


def _letter_values(fold_case: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=U64) * _BASE)
    if fold_case:
        values[65:91] = values[97:123]
    values[list(_SPACES)] = 0
    return values


_VALUES = {fold: _letter_values(fold) for fold in (False, True)}
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(_SPACES)] = True
# for words of letters only: every ASCII byte but A-Z and a-z parts words
_NO_LETTER = np.arange(256) < 128
_NO_LETTER[[*range(65, 91), *range(97, 123)]] = False
_POWERS = [np.ones(1, dtype=U64)]


def _powers(n: int) -> np.ndarray:
    """The first n powers of the base (grown when a longer word comes)."""
    if len(_POWERS[0]) < n:
        steps = np.full(max(n, 1024), _BASE, dtype=U64)
        steps[0] = 1
        _POWERS[0] = np.cumprod(steps)
    return _POWERS[0]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[ends[0]:ends[-1]], ends - ends[0]


def slices(column: pa.Array, limit: int = 1 << 20):
    """Row ranges [lo, hi) of about ``limit`` bytes of text (one row at least),
    which bounds the memory of the vector steps whatever the batch size."""
    if len(column) == 0:
        return
    _, ends = buffers(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + limit, side="right")) - 1)
        yield lo, hi
        lo = hi


class Words:
    """The words of the rows of a text column: ``begin`` and ``end`` (byte
    places in ``flat``), ``hash``, and ``rows`` (word places where each row
    begins, and the total)."""

    def __init__(self, column: pa.Array, fold_case: bool = False, letters_only: bool = False,
                 prefixes: tuple[int, ...] = (), check: bool = False):
        """``check``: also the second hash of each word. ``letters_only``: words are runs of letters and non-ASCII bytes.
        ``prefixes``: also hash the first so many bytes of each word (``prefix_hash``)."""
        self.flat, ends = buffers(column)
        self.ends = ends
        space = (_NO_LETTER if letters_only else _IS_SPACE)[self.flat]
        cut = np.ones(len(self.flat) + 1, dtype=bool)
        cut[1:-1] = space[:-1]
        cut[ends] = True  # words do not run over rows
        self.begin = np.flatnonzero(cut[:-1] & ~space)
        after = np.ones(len(self.flat), dtype=bool)
        after[:-1] = space[1:]
        after[ends[(ends > 0)] - 1] = True
        self.end = np.flatnonzero(after & ~space) + 1
        self.rows = np.searchsorted(self.begin, ends)
        if len(self.begin):
            values = _VALUES[fold_case][self.flat]
            sizes = self.end - self.begin
            longest = int(sizes.max())
            # the place inside the word; white space has the value 0, so its place only has to be in range
            place = np.arange(len(self.flat), dtype=np.int32)
            place[self.begin[0]:] -= np.repeat(self.begin.astype(np.int32), np.diff(np.append(self.begin, len(self.flat))))
            np.minimum(place, longest - 1, out=place)
            values *= _powers(longest)[place]
            if check:
                second = values + _CHECK  # before the first hash's mixing: the two share no mixed value
                second ^= second >> U64(29)
                second *= _M2
                second ^= second >> U64(31)
                second[space] = 0
                self.check = mix(np.add.reduceat(second, self.begin) ^ sizes.astype(U64))
            values ^= values >> U64(32)
            values *= _M1
            values ^= values >> U64(32)
            if letters_only:
                values[space] = 0
            self.hash = mix(np.add.reduceat(values, self.begin) + sizes.astype(U64))
            self.prefix_hash = [mix(np.add.reduceat(np.where(place < p, values, U64(0)), self.begin) + U64(1000 + p))
                                for p in prefixes]
        else:
            self.hash = self.check = np.zeros(0, dtype=U64)
            self.prefix_hash = [self.hash for _ in prefixes]

    @staticmethod
    def ends_of(column: pa.Array) -> np.ndarray:
        """Byte places where each row begins, and the total."""
        return buffers(column)[1]

    def row_of(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of k words, and whether each stays in one row."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, dtype=U64), np.zeros(0, dtype=bool)
        out = np.zeros(n, dtype=U64)
        weights = mix(np.arange(1, k + 1, dtype=U64)) | U64(1)
        for j in range(k):
            out += self.hash[j:j + n] * weights[j]
        rows = self.row_of()
        return mix(out), rows[:n] == rows[k - 1:]

    def joined(self, places: np.ndarray, mark: bytes) -> bytes:
        """The bytes of the words at these places, each followed by ``mark``."""
        data = self.flat.tobytes()
        return b"".join([data[a:b] + mark for a, b in zip(self.begin[places].tolist(), self.end[places].tolist(),
                                                         strict=True)])
