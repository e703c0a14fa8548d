import random
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from odd_rows import no_docs, odd_docs  # noqa: F401
from statforge.llm import packing


def serial_best_fit(lengths, capacity):
    gaps, number = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect_left(gaps, length)
        if at == len(gaps):
            gap, number = capacity, number + 1
        else:
            gap = gaps.pop(at)
        insort(gaps, gap - length)
    return number


def check(rows, docs, capacity=packing.CAPACITY):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = defaultdict(list)
    for doc_id, text in docs:
        ids[doc_id].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [0])
    sequences = defaultdict(list)
    for r in rows:
        own = np.array(ids[r.doc_id][0], "<u4")
        assert zlib.crc32(own[r.start : r.start + r.length].tobytes()) == r.ids_crc32
        assert r.length == capacity or r.piece == 0
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(len(x) for own in ids.values() for x in own)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_odd_rows(odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs).collect()
    check(rows, [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert sum(r.doc_id == 2 for r in rows) == 2
    assert [r.length for r in rows if r.doc_id in (3, 4)] == [1, 1]
    assert packing.pack_documents(no_docs).count() == 0


def test_as_few_sequences_as_serial_best_fit(spark):
    rng = random.Random(3)
    lengths = [rng.choice([rng.randrange(1, 2049), 700, 40]) for _ in range(3000)]
    sized = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id bigint, length bigint").repartition(6)
    rows = packing.best_fit(sized).collect()
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(r.length for r in rows) == sorted(lengths)
    assert all(sum(n for _, n in own) <= 2048 for own in sequences.values())
    assert all(a + n == b for own in sequences.values() for (a, n), (b, _) in zip(sorted(own), sorted(own)[1:], strict=False))
    assert len(sequences) == serial_best_fit(lengths, 2048)


def test_cuts_leave_the_first_piece_short():
    assert packing.cuts(5, 2) == [(0, 1), (1, 3), (3, 5)]
    assert packing.cuts(4, 2) == [(0, 2), (2, 4)] and packing.cuts(1, 2) == [(0, 1)]


def test_ids_are_those_of_the_tokenizer_file(spark):
    text = "Ünïcode  spaces\n\n\ttabs 123 don't <|endoftext|> 漢字 🙂 " + "a" * 3000
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    (row,) = packing.pieces(docs, with_ids=True).collect()
    assert np.frombuffer(row.ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [0]
