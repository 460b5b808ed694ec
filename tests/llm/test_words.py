import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from remitlens.llm import bpe, jaccard_join, line_dedup, packing, substring_dedup, token_counts, words
from tests.llm.data import words_of


def twins(n=2048):
    """Two words whose polynomial hashes modulo 2^64 are equal for every base:
    the letters follow the parity of the ones of their place, and the other parity."""
    a = "".join("ab"[bin(i).count("1") & 1] for i in range(n))
    return a, a.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 2048, 65_536])
def test_twins_have_different_hashes(n):
    a, b = twins(n)
    w = words.Words(pa.array([f"{a} {b}", a]), check=True)
    assert w.hash[0] == w.hash[2] != w.hash[1] and w.check[0] == w.check[2] != w.check[1]


def test_the_second_hash_is_independent():
    w = words.Words(pa.array([" ".join(map(str, range(20_000)))]), check=True)
    assert len(np.unique(w.hash)) == len(np.unique(w.check)) == 20_000
    assert not np.isin(w.hash, w.check).any()


def test_ids_counts_and_pieces_of_twins(spark):
    a, b = twins()
    texts = [a, b, f"{a} {b} one", "x " * 50 + a, "é" * 30_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in bpe.encode_texts(docs, path).collect()}
    assert [got[i] for i in range(len(texts))] == want
    pieces = packing.pack_documents(docs, path).collect()
    assert sum(r.length for r in pieces) == sum(len(w) + 1 for w in want)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, path, 1024).collect()}
    assert [got[i] for i in range(len(texts))] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_pieces_of_equal_hash_are_told_apart(monkeypatch):
    """With first hashes of two bits, the second hash still finds every piece."""
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [" ".join(f"w{i * j}" for i in range(40)) for j in range(1, 8)]
    plain = bpe.WordCodec(path).encode(pa.array(texts))[0].tolist()
    whole = words.Words.__init__

    def narrow(self, *args, **kw):
        whole(self, *args, **kw)
        self.hash = self.hash & np.uint64(3)

    monkeypatch.setattr(words.Words, "__init__", narrow)
    codec = bpe.WordCodec(path)
    assert codec.encode(pa.array(texts))[0].tolist() == plain
    one = [codec.encode(pa.array([w]))[0].tolist() for w in words_of(" ".join(texts))]  # cached pieces of equal hash
    assert sum(one, []) == plain


def test_documents_of_twins_keep_their_words(spark):
    a, b = twins()
    rest = " ".join(f"r{i}" for i in range(12))
    rows = [(1, f"{a} {rest}"), (2, f"{b} {rest}"), (3, f"{a} {rest}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: (r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(docs, digest=True).collect()}
    digest = [hashlib.sha256(t.encode()).hexdigest() for _, t in rows]
    assert out == {1: (0, digest[0]), 2: (0, digest[1]), 3: (13, hashlib.sha256(b"").hexdigest())}
    short = spark.createDataFrame([(1, f"{a} x"), (2, f"{b} x"), (3, f"{a} x")], "doc_id long, text string")
    found, _ = jaccard_join.near_duplicates(short)
    assert {r.id: r.component_id for r in found.collect()} == {1: 1, 2: 2, 3: 1}
    lines = spark.createDataFrame([(i, a if i < 10 else b) for i in range(11)], "doc_id long, text string")
    kept = line_dedup.drop_common_lines(lines, min_docs=10, min_chars=1).collect()
    assert {r.doc_id: r.n_dropped for r in kept} == {i: int(i < 10) for i in range(11)}
