import hashlib
import random
import string

from odd_rows import no_docs, odd_docs  # noqa: F401
from statforge.llm import exact

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc_id)
    out = []
    for doc_id, text in rows:
        group = groups[(text or "").translate(LOWER)]
        keep = max((i for i in group if i is not None), default=None)
        out.append((doc_id, keep, len(group), doc_id == keep, hashlib.sha256((text or "").translate(LOWER).encode()).hexdigest()))
    return sorted(out, key=str)


def test_report_equals_brute_force(spark, odd_docs):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "A", "Ä", "ä", None, "", "b c"]) if i % 3 else f"t{i // 9}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert sorted(map(tuple, exact.exact_dedup(df).collect()), key=str) == expected(rows)
    odd = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted(map(tuple, exact.exact_dedup(odd_docs).collect()), key=str) == expected(odd)


def test_empty_table(no_docs):
    assert exact.exact_dedup(no_docs).count() == 0
    assert exact.drop_copies(no_docs).count() == 0


def test_drop_copies_keeps_one_row_and_all_columns(odd_docs):
    left = exact.drop_copies(odd_docs)
    assert left.columns == odd_docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([2, 4, 5, 6, 7, None], key=str)


def test_filter_grows_finds_and_forgets():
    digests = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(6000)]
    index = exact.CuckooIndex(buckets=4)
    for i, digest in enumerate(digests):
        index.add(digest, i, 1)
    assert index.mask > 1000 and index.size == 6000
    assert all(index.find(d) == [i, 1] for i, d in enumerate(digests))
    assert index.find(hashlib.sha256(b"other").hexdigest()) is None
    for digest in digests[::2]:
        assert index.remove(digest)
    assert not index.remove(digests[0])
    assert [index.find(d) is None for d in digests] == [i % 2 == 0 for i in range(6000)]
    assert sum(map(len, index.table)) == 3000


def test_update_withdraws_and_adds(spark):
    rows = exact.digests(spark.createDataFrame([(1, "a"), (2, "b"), (3, "A")], "doc_id bigint, text string"))
    index = exact.build_index(rows, 3)
    added = exact.digests(spark.createDataFrame([(9, "c"), (7, "a")], "doc_id bigint, text string"))
    gone = exact.digests(spark.createDataFrame([(2, "b"), (5, "never")], "doc_id bigint, text string"))
    after = {(r.keep_id, r.group_size) for r in exact.update_index(index, 3, added, gone).collect()}
    assert after == {(7, 3), (9, 1)}
