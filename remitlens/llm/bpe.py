"""Byte-pair encoding and decoding of whole texts (operator 10).

The merges run in numpy rounds over many words at once. All symbols of all
words lie in one flat array. In a round each word finds its pair of lowest
rank by binary search over the sorted pair keys, and every word merges all
places of its own best pair. Words without a known pair leave. That equals
merging one pair at a time if each merge makes a token of its own and uses
only tokens made by earlier merges. ``Bpe`` proves this for its file and
refuses a file without it.

Texts are cut at white space first. A piece's ids depend on that piece alone,
so a worker keeps the ids of pieces it has met (``PieceCache``, numpy arrays of
bounded size, looked up by a 64-bit hash). The cache is a speed-up only: a full
one is emptied, and results never depend on it.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from remitlens.llm.workers import kept
from remitlens.llm.words import Words, slices

CACHE_PIECES = 500_000
SLICE_BYTES = 2 << 20
NEVER = np.int64(1 << 62)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Bpe:
    """A byte-level BPE vocabulary read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        letters = byte_letters()
        self.first = np.array([self.vocab[c] for c in letters], dtype=np.int64)
        self.last = np.array([self.vocab[c + suffix] for c in letters], dtype=np.int64)
        basic = {*self.first.tolist(), *self.last.tolist()}
        rows, made = [], set(basic)
        for rank, (left, right) in enumerate(model["merges"]):
            a, b, c = self.vocab[left], self.vocab[right], self.vocab[left + right]
            if c in made or a not in made or b not in made:
                raise ValueError(f"merge {rank} of {path} doesn't make a new token from earlier ones")
            made.add(c)
            rows.append(((a << 32) | b, rank, c))
        self.merged_of_rank = np.array([c for _, _, c in rows], dtype=np.int64)
        rows.sort()
        self.keys = np.array([key for key, _, _ in rows], dtype=np.int64)
        self.ranks = np.array([rank for _, rank, _ in rows], dtype=np.int64)
        self.token_text = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, by binary search over the sorted keys (NEVER if unknown)."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)

    def encode_words(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each) for words of ``sizes`` (1 at
        least) bytes that follow each other in ``flat``, each encoded alone."""
        if not len(sizes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends = np.cumsum(sizes)
        symbol = self.first[flat]
        symbol[ends - 1] = self.last[flat[ends - 1]]
        word = np.repeat(np.arange(len(sizes)), sizes)
        rank = np.full(len(symbol), NEVER)
        if len(symbol) > 1:
            inner = np.flatnonzero(word[:-1] == word[1:])
            rank[inner] = self._rank(symbol[inner], symbol[inner + 1])
        done_symbol, done_word = [], []
        while len(symbol):
            begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.append(begin, len(word)))
            best = np.minimum.reduceat(rank, begin)
            active = np.repeat(best < NEVER, size)
            if not active.all():
                done_symbol.append(symbol[~active])
                done_word.append(word[~active])
                symbol, word, rank = symbol[active], word[active], rank[active]
                size, best = size[best < NEVER], best[best < NEVER]
                if not len(symbol):
                    break
            hit = rank == np.repeat(best, size)
            if (overlap := hit[1:] & hit[:-1]).any():  # x x x: from the left, every second place of a run
                place = np.arange(len(hit))
                run = np.maximum.accumulate(np.where(hit & ~np.concatenate([[False], overlap]), place, 0))
                hit &= (place - run) % 2 == 0
            at = np.flatnonzero(hit)
            symbol[at] = self.merged_of_rank[rank[at]]
            keep = np.ones(len(symbol), dtype=bool)
            keep[at + 1] = False
            at -= np.arange(len(at))  # one symbol went for each earlier merge
            symbol, word, rank = symbol[keep], word[keep], rank[keep]
            for i in (at, at[at > 0] - 1):
                j = np.minimum(i + 1, len(symbol) - 1)
                rank[i] = np.where((word[i] == word[j]) & (j > i), self._rank(symbol[i], symbol[j]), NEVER)
        symbol, word = np.concatenate(done_symbol), np.concatenate(done_word)
        return symbol[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(sizes))


class PieceCache:
    """Hash of a piece -> its run of values, in sorted numpy arrays. A second
    hash of each piece tells pieces of equal first hash apart."""

    def __init__(self, limit: int = CACHE_PIECES):
        self.limit = limit
        self.clear()

    def clear(self):
        self.keys = self.checks = np.zeros(0, np.uint64)
        self.begin = self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def add(self, keys: np.ndarray, checks: np.ndarray, sizes: np.ndarray, values: np.ndarray):
        """Add sorted new keys with their runs."""
        at = np.searchsorted(self.keys, keys)
        self.begin = np.insert(self.begin, at, len(self.flat) + np.cumsum(sizes) - sizes)
        self.keys, self.size = np.insert(self.keys, at, keys), np.insert(self.size, at, sizes)
        self.checks = np.insert(self.checks, at, checks)
        self.flat = np.concatenate([self.flat, values.astype(np.int32)])

    def runs(self, key: np.ndarray, check: np.ndarray, make) -> tuple[np.ndarray, np.ndarray]:
        """(values of all pieces in order, number of values of each) by the
        pieces' two hashes; ``make(places)`` gives (sizes, values) of new ones."""
        unique, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        if (check[first][inverse] != check).any():  # different pieces of one hash: none is looked up by it
            return make(np.arange(len(key)))[::-1]
        at = self.find(unique)
        if (self.checks[at[at >= 0]] != check[first[at >= 0]]).any():  # the cache holds another piece of this hash
            self.clear()
        missing = self.find(unique) < 0
        if missing.any():
            if len(self.keys) + int(missing.sum()) > self.limit:
                self.clear()
                missing[:] = True
            self.add(unique[missing], check[first[missing]], *make(first[missing]))
        at = self.find(unique)[inverse]
        sizes = self.size[at]
        before = np.cumsum(sizes) - sizes
        return self.flat[np.repeat(self.begin[at] - before, sizes) + np.arange(int(sizes.sum()))], sizes


# The word pattern of the vocabulary file, with a line end as the mark between pieces.
_WORD_PATTERN = r"\n|'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"


class WordCodec:
    """The lower-casing word BPE: NFC, white space to one space, lower case,
    word pattern, byte-level BPE with an end-of-word suffix."""

    def __init__(self, path: str):
        self.bpe = Bpe(path)
        self.pattern = regex.compile(_WORD_PATTERN)
        self.cache = PieceCache()

    def _plain(self, pieces: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each piece, ids) of pieces that end in a line end each."""
        text = unicodedata.normalize("NFC", pieces.decode())
        # letter by letter: str.lower() treats a final capital sigma by its neighbours
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        flat = np.frombuffer(" ".join(self.pattern.findall(text)).encode() + b" ", dtype=np.uint8)
        end = np.flatnonzero(flat == 32)
        sizes = np.diff(end, prepend=-1) - 1
        mark = flat[end - 1] == 10
        piece = np.cumsum(mark) - mark
        ids, count = self.bpe.encode_words(flat[(flat != 32) & (flat != 10)], sizes[~mark])
        return np.bincount(piece[~mark], weights=count, minlength=int(mark.sum())).astype(np.int64), ids

    def _special(self, piece: bytes) -> list[int]:
        out: list[int] = []
        for part in self.bpe.special_split.split(piece.decode()):
            out += [self.bpe.special[part]] if part in self.bpe.special \
                else self._plain(part.encode() + b"\n")[1].tolist()
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, row ends with a leading 0) of a string column."""
        words = Words(column, check=True)

        def make(places):
            pieces = words.joined(places, b"\n")
            if b"<|" not in pieces:
                return self._plain(pieces)
            runs = [self._special(piece) for piece in pieces[:-1].split(b"\n")]
            return np.array([len(r) for r in runs], np.int64), np.array([i for r in runs for i in r], np.int64)

        ids, sizes = self.cache.runs(words.hash, words.check, make)
        return ids, np.concatenate([[0], np.cumsum(sizes)])[words.rows]


def encode_texts(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 digests: bool = False) -> DataFrame:
    """Encode and decode every whole text with the word vocabulary at ``path``.

    Returns the ``keep`` columns and either ``ids`` (packed little-endian
    unsigned 32-bit) and ``decoded``, or with ``digests`` ``n_tokens``,
    ``ids_sha256`` (of the decimal ids joined by one space) and
    ``decoded_sha256``. One pass over the rows without a shuffle.

    Null and empty texts, and texts of white space, give no ids and an empty
    decoded text. Special strings inside a text give their special id. Null
    keys and repeated rows are kept as they are, other columns are not read; an
    empty table gives no rows. One slice of about 2 MB (or one longer text) is
    held at a time.
    """
    schema = [(k, docs.schema[k].dataType.simpleString()) for k in keep]
    schema += [("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")] if digests \
        else [("ids", "binary"), ("decoded", "string")]

    def run(batches):
        codec = kept(("word", path), lambda: WordCodec(path))
        strings = _strings(codec.bpe)
        decimal = np.array([str(i) for i in range(len(strings))], dtype=object)
        for batch in batches:
            column = batch.column(len(keep))
            for lo, hi in slices(column, SLICE_BYTES):
                ids, ends = codec.encode(column.slice(lo, hi - lo))
                a, b = [], []
                for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    decoded = " ".join(strings[ids[i:j]].tolist())
                    if digests:
                        a.append(hashlib.sha256(" ".join(decimal[ids[i:j]].tolist()).encode()).hexdigest())
                        b.append(hashlib.sha256(decoded.encode()).hexdigest())
                    else:
                        a.append(ids[i:j].astype("<u4").tobytes())
                        b.append(decoded)
                cols = [batch.column(i).slice(lo, hi - lo) for i in range(len(keep))]
                cols += [pa.array(np.diff(ends), pa.int64())] if digests else []
                cols += [pa.array(a, pa.string() if digests else pa.binary()), pa.array(b, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=[name for name, _ in schema])

    return docs.select(*[docs[k] for k in keep], docs[text].alias("__text")).mapInArrow(
        run, ", ".join(f"`{name}` {kind}" for name, kind in schema))


def _strings(bpe: Bpe) -> np.ndarray:
    return np.array([bpe.token_text.get(i) for i in range(max(bpe.token_text) + 1)], dtype=object)


def decode_ids(docs: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``decoded``: the vocabulary's strings of packed ids, joined by one space
    (this vocabulary has no decoder). Null ids give an empty text; an id that
    the vocabulary lacks is left out, as the library does."""
    schema = [(k, docs.schema[k].dataType.simpleString()) for k in keep] + [("decoded", "string")]

    def run(batches):
        texts = kept(("texts", path), lambda: Bpe(path)).token_text
        for batch in batches:
            out = [" ".join([texts[i] for i in np.frombuffer(v or b"", dtype="<u4").tolist() if i in texts])
                   for v in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(out, pa.string())],
                                             names=[name for name, _ in schema])

    return docs.select(*[docs[k] for k in keep], docs[ids].alias("__ids")).mapInArrow(
        run, ", ".join(f"`{name}` {kind}" for name, kind in schema))


def id_pieces(docs: DataFrame, path: str, size: int, end_id: int, text: str = "text",
              key: str = "doc_id") -> DataFrame:
    """Cut each text's ids, followed by ``end_id``, into pieces of ``size``:
    (key, piece, start, length, ids_crc32). Same rules as ``encode_texts``."""
    schema = [(key, docs.schema[key].dataType.simpleString()), ("piece", "int"), ("start", "bigint"),
              ("length", "bigint"), ("ids_crc32", "bigint")]

    def run(batches):
        codec = kept(("word", path), lambda: WordCodec(path))
        for batch in batches:
            column = batch.column(1)
            for lo, hi in slices(column, SLICE_BYTES):
                ids, ends = codec.encode(column.slice(lo, hi - lo))
                row, start, length, crc = [], [], [], []
                for k, (i, j) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
                    own = np.append(ids[i:j], end_id).astype("<u4")
                    for at in range(0, len(own), size):
                        part = own[at:at + size]
                        row.append(lo + k)
                        start.append(at)
                        length.append(len(part))
                        crc.append(zlib.crc32(part))
                start = np.array(start, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row, pa.int64())), pa.array((start // size).astype(np.int32)),
                     pa.array(start), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=[name for name, _ in schema])

    return docs.select(docs[key], docs[text].alias("__text")).mapInArrow(
        run, ", ".join(f"`{name}` {kind}" for name, kind in schema))
