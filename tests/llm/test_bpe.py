import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_rows import no_docs, odd_docs  # noqa: F401
from tokenizers import Tokenizer

from statforge.llm import bpe


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.MODEL)


def test_documents_equal_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(texts) > 100
    for r in bpe.token_digests(docs).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=12), st.sampled_from(["don't", "I'LL", "<|endoftext|>", "<|startoftext|>", "<|end", "ΟΔΟΣ", "é", "é", "123 45", "\x1c\x85 ", "Ꟑ", "\U00016ea0x", "ﬁ", "İ"]))))
def test_any_text_equals_the_library(parts):
    library, text = bpe.encoder(bpe.MODEL).rules, "".join(parts)
    ids = bpe.encoder(bpe.MODEL).encode(text)
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert bpe.encoder(bpe.MODEL).decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_long_and_short_words_merge_alike(library):
    rng, coder = random.Random(3), bpe.Encoder()
    for size in (1, 2, 3, 20, 90, 400):
        for letters in ("ab", "aeiourstn", "aaaaab"):
            raw = "".join(rng.choice(letters) for _ in range(size)).encode()
            parts = [coder.first[b] for b in raw[:-1]] + [coder.last[raw[-1]]]
            short, long = bpe.merge_short(parts, coder.ranks, coder.made), bpe.merge_long(parts, coder.ranks, coder.made)
            assert short == long
            assert short[0] == library.encode(raw.decode(), add_special_tokens=False).ids
            assert short[1][0] == 0 and short[1] == sorted(set(short[1]))


def test_a_very_long_word_takes_no_quadratic_time():
    word = "lorem" * 100_000
    assert bpe.encoder(bpe.MODEL).encode(word).size > 100_000


def test_odd_rows(spark, odd_docs, no_docs, library):
    found = bpe.decode_documents(bpe.encode_documents(odd_docs)).collect()
    assert len(found) == odd_docs.count()
    for r in found:
        if r.doc_id in (3, 4, 5):
            assert r.ids == b"" and r.decoded == ""
    ids = np.frombuffer(next(r.ids for r in found if r.doc_id == 7), "<u4")
    assert 49407 in ids.tolist()
    assert bpe.token_digests(no_docs).count() == 0


def test_unknown_ids_are_passed_over():
    assert bpe.encoder(bpe.MODEL).decode(np.array([320, 2**31], "<u4")) == bpe.encoder(bpe.MODEL).decode(np.array([320], "<u4"))
