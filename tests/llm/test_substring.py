import hashlib
import random
from collections import Counter

import numpy as np
import zstandard
from odd_rows import no_docs, odd_docs  # noqa: F401
from statforge.llm import substring


def brute(rows, window):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    counts = Counter(tuple(w[i : i + window]) for _, w in words for i in range(len(w) - window + 1))
    out = []
    for doc_id, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((doc_id, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def texts(rng, number):
    passages = [[f"p{i}_{j}" for j in range(rng.randrange(30, 60))] for i in range(4)]
    out = []
    for i in range(number):
        own = [f"u{i}_{j}" if rng.random() < 0.7 else rng.choice("abc") for j in range(rng.randrange(0, 120))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(own) + 1)
            own[at:at] = rng.choice(passages)
        out.append("  ".join(own))
    return out


def same(spark, rows, **parameters):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = sorted(map(tuple, substring.remove_repeats(df, **parameters).collect()), key=str)
    assert got == brute(rows, parameters.get("window", substring.WINDOW))


def test_equals_brute_force(spark):
    rng = random.Random(6)
    rows = list(enumerate(texts(rng, 120)))
    rows += [(500, "The " * 100), (501, "x y " * 60), (502, None), (503, ""), (504, "a b"), (505, " ".join(map(str, range(35)))), (506, " ".join(map(str, range(35))))]
    rows += [(None, "n " * 36), (7, rows[7][1])]
    same(spark, rows)


def test_frequent_grams_are_passed_over(spark):
    """A passage in every document, in different surroundings, and copies; short windows make nearly all grams frequent."""
    rng = random.Random(7)
    passage = " ".join(f"p{j}" for j in range(50))
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(20)) + f" {passage} " + " ".join(rng.choice("xyz") for _ in range(20))) for i in range(200)]
    same(spark, rows)
    same(spark, rows, window=9, gram=2)


def shared_line(number):
    """Short documents, a third of them with one line."""
    rng = random.Random(8)
    line = " ".join(f"l{j}" for j in range(40))
    return [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) + (f" {line}" if i % 3 == 0 else "")) for i in range(number)]


def test_a_bucket_holds_few_places_of_a_line_in_many_documents(spark):
    unpack = zstandard.ZstdDecompressor().decompress
    most = []
    for number in (600, 2400):
        df = spark.createDataFrame(shared_line(number), "doc_id bigint, text string").repartition(2)
        packed = substring.super_kmers(substring._keyed(df), 35, 5, 8, np.zeros(0, "uint64")).collect()
        places = [(row.bucket, p) for row in packed for p in zip(*(np.frombuffer(unpack(row[name]), kind).tolist() for name, kind in substring._PLACES), strict=True)]
        assert len(places) == len(set(places)) >= number // 3
        inside = [len(unpack(row.ids)) // 8 - unpack(row.strings).count(b"\n") - 1 for row in packed if row.bucket >= 0]
        most.append(max(inside))
    # Beyond one place for each string there is only the bounded rest, in 800 shared lines as in 200.
    assert max(most) <= substring.INLINE
    same(spark, shared_line(900))


def test_merged_intervals_cover_the_same_words():
    rng = np.random.default_rng(9)
    ids, hashes, begins, sizes = (rng.integers(0, n, 400) for n in (5, 3, 300, 12))
    merged = list(zip(*substring.merged_intervals(ids, hashes, begins, begins + sizes + 1), strict=True))
    cover = lambda spans: {(i, h, w) for i, h, b, e in spans for w in range(b, e)}
    assert cover(merged) == cover(zip(ids, hashes, begins, begins + sizes + 1, strict=True))
    assert len(merged) < 400


def test_same_text_and_id_in_many_rows(spark):
    """Flushes that hold the same places, and strings with few and many places."""
    rows = [(None, "r " * 40)] * 30 + [(4, " ".join(f"s{j}" for j in range(50)))] * 40 + [(i, " ".join(f"t{j % 45}" for j in range(200))) for i in range(10, 30)]
    same(spark, rows)
    same(spark, rows, window=9, gram=2)


def test_odd_rows_and_text_output(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted(map(tuple, substring.remove_repeats(odd_docs).collect()), key=str) == brute(rows, 35)
    assert substring.remove_repeats(no_docs).count() == 0
    kept = {r.doc_id: r.kept for r in substring.remove_repeats(odd_docs, window=7, gram=3, with_text=True).collect()}
    assert kept[1] == "One two three four five six seven." and kept[2] == ""
