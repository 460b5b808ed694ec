"""Token counts of whole texts (operator 4) with the whole-token shortcut.

Once per vocabulary, ``WholeTokens`` merges every vocabulary string alone and
keeps those that end as one token: the proven strings. A pre-token that equals
a proven string counts as one token without any merge; only the others go
through the batched merges of ``bpe.Bpe``.

Pre-tokens of this vocabulary keep one space in front of a word and treat white
space by rule, so a text is cut at ASCII white space into pieces (with or
without a space in front) and gaps. Counts of pieces met before come from the
worker's bounded cache. Texts with other white space or special strings take
the plain way: split at special strings, the whole pattern on each part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from remitlens.llm.bpe import Bpe, PieceCache, byte_letters
from remitlens.llm.workers import kept
from remitlens.llm.words import Words, slices

SLICE_BYTES = 2 << 20
# The byte-level pre-token pattern, its white space, and all other white space of Unicode.
_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
            r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
_OTHER_SPACE = "[\x85\xa0  -     　]"
_WITH_SPACE = np.uint64(0x5851F42D4C957F2D)


class WholeTokens:
    """Counts tokens of a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        self.bpe = Bpe(path)
        self.pattern = regex.compile(_PATTERN)
        self.in_pieces = regex.compile(r"\n|" + _PATTERN)
        self.other_space = regex.compile(_OTHER_SPACE)
        self.plain_way = regex.compile("|".join([_OTHER_SPACE, *map(regex.escape, self.bpe.special)]))
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        strings = [bytes(map(byte_of.__getitem__, t)) for t, i in self.bpe.vocab.items()
                   if i not in self.bpe.special.values()]
        sizes = np.array([len(s) for s in strings], dtype=np.int64)
        _, count = self.bpe.encode_words(np.frombuffer(b"".join(strings), np.uint8), sizes)
        # the proof: a vocabulary string alone ends as one token (as the bytes fix the result, as this token)
        self.proven = {s.decode() for s, n in zip(strings, count.tolist(), strict=True)
                       if n == 1 and _is_text(s)}
        self.cache = PieceCache()

    def pre_token_counts(self, tokens: list[str]) -> np.ndarray:
        """Number of tokens of each pre-token."""
        out = np.fromiter(map(self.proven.__contains__, tokens), dtype=np.int64, count=len(tokens))
        rest = [tokens[i].encode() for i in np.flatnonzero(out == 0).tolist()]
        if rest:
            _, out[out == 0] = self.bpe.encode_words(np.frombuffer(b"".join(rest), np.uint8),
                                                     np.array([len(r) for r in rest], np.int64))
        return out

    def plain(self, text: str) -> int:
        """The plain way: special strings count one, the rest is split by the pattern."""
        parts = self.bpe.special_split.split(text)
        tokens = [t for part in parts if part not in self.bpe.special for t in self.pattern.findall(part)]
        return int(self.pre_token_counts(tokens).sum()) + sum(p in self.bpe.special for p in parts)

    def count(self, column: pa.Array) -> np.ndarray:
        """Number of tokens of each row of a string column."""
        words = Words(column, check=True)
        flat, ends = words.flat, words.ends
        out = np.zeros(len(ends) - 1, dtype=np.int64)
        row = words.row_of()
        if len(words.begin):
            # a space right before a word belongs to the word's piece
            before = np.maximum(words.begin - 1, 0)
            led = (words.begin > ends[row]) & (flat[before] == 32)

            def make(places):
                data = flat.tobytes()
                pieces = b"\n".join([data[a:b] for a, b in zip((words.begin[places] - led[places]).tolist(),
                                                               words.end[places].tolist(), strict=True)]) + b"\n"
                # rows with other white space take the plain way below: here it must only not join two pieces
                tokens = self.in_pieces.findall(self.other_space.sub("x", pieces.decode()))
                mark = np.fromiter(map("\n".__eq__, tokens), dtype=bool, count=len(tokens))
                piece = (np.cumsum(mark) - mark)[~mark]
                count = self.pre_token_counts([t for t in tokens if t != "\n"])
                return np.ones(len(places), np.int64), np.bincount(piece, weights=count, minlength=len(places))

            count, _ = self.cache.runs(np.where(led, words.hash * _WITH_SPACE, words.hash),
                                       np.where(led, ~words.check, words.check), make)
            out = np.add.reduceat(np.append(count, 0).astype(np.int64), np.minimum(words.rows[:-1], len(count)))
            out[words.rows[:-1] == words.rows[1:]] = 0
        else:
            led = np.zeros(0, dtype=bool)
        # gaps: the white space before each word (without the space it took) and behind the last word of a row
        first = np.zeros(len(words.begin), dtype=bool)
        first[words.rows[:-1][words.rows[:-1] < words.rows[1:]]] = True
        gap_begin = np.where(first, ends[row], np.concatenate([[0], words.end[:-1]])) if len(row) else row
        gap_end = words.begin - led
        last = np.where(words.rows[:-1] < words.rows[1:], np.append(words.end, 0)[words.rows[1:] - 1], ends[:-1])
        behind = np.flatnonzero(last < ends[1:])
        self._gaps(out, row, gap_begin, gap_end, np.flatnonzero(gap_end > gap_begin), flat, led)
        data = flat.tobytes()
        for r in behind.tolist():  # white space that ends a text is one pre-token
            out[r] += int(self.pre_token_counts([data[last[r]:ends[r + 1]].decode()])[0])
        odd = np.flatnonzero(np.add.reduceat(np.append(flat >= 128, False).astype(np.int64),
                                             np.minimum(ends[:-1], len(flat))) > 0) if len(out) else []
        for r in {*odd.tolist()} | {*self._special_rows(data, ends)} if len(out) else ():
            text = data[ends[r]:ends[r + 1]].decode()
            if self.plain_way.search(text):
                out[r] = self.plain(text)
        return out

    def _special_rows(self, data: bytes, ends: np.ndarray) -> list[int]:
        at = [m.start() for s in self.bpe.special for m in regex.finditer(regex.escape(s.encode()), data)]
        return (np.searchsorted(ends, np.array(at, dtype=np.int64), side="right") - 1).tolist()

    def _gaps(self, out, row, begin, end, places, flat, led):
        """Add the tokens of the white space before words: all but the last
        byte as one pre-token, the last byte as another if the word didn't take it."""
        data = flat.tobytes()
        tokens, rows = [], []
        single = places[(end[places] - begin[places] == 1) & ~led[places]]
        for value in np.unique(flat[begin[single]]).tolist():  # one byte alone: the usual line end
            n = int(self.pre_token_counts([chr(value)])[0])
            np.add.at(out, row[single[flat[begin[single]] == value]], n)
        for w in np.setdiff1d(places, single, assume_unique=True).tolist():
            a, b = int(begin[w]), int(end[w])
            cut = b if led[w] else b - 1
            tokens += [data[a:cut].decode()] + ([] if led[w] else [data[cut:b].decode()])
            rows += [row[w]] * (1 if led[w] else 2)
        if tokens:
            np.add.at(out, rows, self.pre_token_counts(tokens))


def _is_text(s: bytes) -> bool:
    try:
        s.decode()
    except UnicodeDecodeError:
        return False
    return True


def count_tokens(docs: DataFrame, path: str, limit: int, text: str = "text",
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens)
    of every whole text under the byte-level vocabulary at ``path``, with the
    ``keep`` columns. One pass over the rows without a shuffle.

    A null text counts as empty: 0 bytes, 0 tokens. Special strings inside a
    text count as their one token, as in the library's default. Repeated rows
    and null keys are kept; other columns are not read; an empty table gives no
    rows. Very long texts are whole, one at a time.
    """
    schema = [(k, docs.schema[k].dataType.simpleString()) for k in keep]
    schema += [("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]

    def run(batches):
        counter = kept(("whole", path), lambda: WholeTokens(path))
        for batch in batches:
            column = batch.column(len(keep))
            for lo, hi in slices(column, SLICE_BYTES):
                part = column.slice(lo, hi - lo)
                n = counter.count(part)
                size = np.diff(Words.ends_of(part))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(lo, hi - lo) for i in range(len(keep))),
                     pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit)],
                    names=[name for name, _ in schema])

    return docs.select(*[docs[k] for k in keep], docs[text].alias("__text")).mapInArrow(
        run, ", ".join(f"`{name}` {kind}" for name, kind in schema))
