import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from remitlens.llm import bpe, token_counts
from remitlens.session import materialize
from tests.llm.data import edge_docs, empty_docs

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
BITS = ["a", "B", "é", "É", "é", "ß", "Σ", "ς", "İ", "ﬁ", " ", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x1c",
        "\x85", "\xa0", " ", "　", "​", "1", "²", "٣", "'s", "'LL", "'ll", "<|endoftext|>", "<|startoftext|>",
        "<|ENDOFTEXT|>", "<|", "!", "!!", "—", "日", "😀", "\0", "aaaa", "K", "ǆ", "the", " the", "hello"]


def odd_texts(n=3000, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 25))) for _ in range(n)] + ["", " ", "\n", "a" * 5000]


def test_word_ids_equal_the_library():
    codec, lib, texts = bpe.WordCodec(WORD), Tokenizer.from_file(WORD), odd_texts()
    ids, ends = codec.encode(pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[ends[i]:ends[i + 1]].tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_a_full_cache_changes_nothing():
    codec, texts = bpe.WordCodec(WORD), odd_texts(400)
    want = codec.encode(pa.array(texts))
    codec.cache = bpe.PieceCache(limit=50)
    for lo in range(0, len(texts), 20):
        ids, _ = codec.encode(pa.array(texts[lo:lo + 20]))
        assert ids.tolist() == want[0][want[1][lo]:want[1][min(lo + 20, len(texts))]].tolist()


def test_counts_equal_the_library():
    counter, lib, texts = token_counts.WholeTokens(BYTE), Tokenizer.from_file(BYTE), odd_texts()
    want = [len(lib.encode(t, add_special_tokens=False).ids) for t in texts]
    assert counter.count(pa.array(texts)).tolist() == want


def test_proven_strings_are_one_token():
    lib = Tokenizer.from_file(BYTE)
    proven = sorted(token_counts.WholeTokens(BYTE).proven)
    vocab = {lib.decode([i]) for i in range(lib.get_vocab_size())}
    assert len(proven) > 45_000 and set(proven) <= vocab
    for s in proven[::97]:
        n = len(lib.encode(s, add_special_tokens=False).ids)
        assert n == 1 or len(lib.pre_tokenizer.pre_tokenize_str(s)) > 1


def test_a_file_without_the_merge_property_is_refused(tmp_path):
    import json
    with open(WORD, encoding="utf-8") as f:
        spec = json.load(f)
    spec["model"]["merges"].append(spec["model"]["merges"][0])
    bad = tmp_path / "bad.json"
    bad.write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="new token"):
        bpe.Bpe(str(bad))


def test_round_trip_on_edge_rows(spark):
    lib = Tokenizer.from_file(WORD)
    docs = edge_docs(spark)
    out = materialize(bpe.encode_texts(docs, WORD, keep=("doc_id", "text")))
    for r in out.collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == lib.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == lib.decode(ids, skip_special_tokens=False)
    again = bpe.decode_ids(out.withColumnRenamed("decoded", "want"), WORD, keep=("want",))
    assert again.where("want <> decoded").count() == 0
    digests = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_texts(docs, WORD, digests=True).collect()}
    assert digests == {(r.doc_id, len(r.ids) // 4,
                        hashlib.sha256(" ".join(map(str, np.frombuffer(r.ids, "<u4"))).encode()).hexdigest(),
                        hashlib.sha256(r.decoded.encode()).hexdigest()) for r in out.collect()}
    assert bpe.encode_texts(empty_docs(spark), WORD, digests=True).count() == 0


def test_counts_on_edge_rows(spark):
    lib = Tokenizer.from_file(BYTE)
    for r in token_counts.count_tokens(edge_docs(spark), BYTE, limit=100, keep=("doc_id", "text")).collect():
        n = len(lib.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 100)
    assert token_counts.count_tokens(empty_docs(spark), BYTE, limit=1).count() == 0
