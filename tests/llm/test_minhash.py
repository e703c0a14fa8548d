import random
import string
from itertools import combinations

import numpy as np

from odd_rows import no_docs, odd_docs  # noqa: F401
from statforge.llm import minhash
from statforge.llm.shared import WordHashes, mixed

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sets_of(rows):
    out = {}
    for doc_id, text in rows:
        words = (text or "").translate(LOWER).encode().split()
        out[doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    return out


def components(sets):
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 75 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def family(rng, words, copies, edits):
    out = []
    for _ in range(copies):
        own = list(words)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(len(own))] = f"new{rng.random()}"
        out.append(" ".join(own))
    return out


def test_components_equal_brute_force(spark):
    rng = random.Random(2)
    texts = []
    for i in range(6):
        texts += family(rng, [f"w{i}_{j}" for j in range(150)], 12, 8)
    shared = [f"s{j}" for j in range(60)]
    texts += [" ".join(shared + [f"own{i}_{j}" for j in range(40)]) for i in range(40)]  # a common passage, no links
    texts += ["a b c d", "A B  c d", "a b c", "", None, "x", "x"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()}
    sets = sets_of(rows)
    wanted = components(sets)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(s), wanted[i], wanted[i] == i) for i, s in sets.items()}


def test_chain_and_odd_rows(spark, odd_docs, no_docs):
    base = [f"w{i}" for i in range(104)]
    chain = [" ".join(base[:i] + [f"n{j}" for j in range(i)] + base[2 * i :] if i else base) for i in range(0, 4)]
    rows = list(enumerate(chain, 10))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == components(sets_of(rows))
    found = minhash.near_duplicates(odd_docs).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in found), key=str) == sorted(
        [(1, 1, True), (2, 1, False), (2, 1, False), (3, 3, True), (4, 4, True), (5, 5, True), (6, 6, True), (7, 7, True), (None, None, True)], key=str
    )
    left = minhash.drop_near_copies(odd_docs)
    assert left.columns == odd_docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([1, 3, 4, 5, 6, 7, None], key=str)
    assert minhash.near_duplicates(no_docs).count() == minhash.drop_near_copies(no_docs).count() == 0


def test_signatures_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 1500, dtype="uint64")
    a, b = np.unique(pool[:1200]), np.unique(pool[300:])
    signer = minhash.MinMax(200, 10)
    agree = float((signer.signature(a) == signer.signature(b)).mean())
    assert abs(agree - 900 / 1500) < 0.06


def test_shingles_are_sets_of_five_words():
    hashes = WordHashes()
    assert len(minhash.shingles(b"a b c d e a b c d e", hashes)) == 5
    assert len(minhash.shingles(b"a b", hashes)) == 1 and len(minhash.shingles(b" \n", hashes)) == 0
    assert minhash.shingles(b"a  b\tc", hashes).tolist() == minhash.shingles(b"a b c", hashes).tolist()


def test_disagreements_count_differing_places(spark):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 2**32, 300, dtype="uint32"), rng.integers(0, 2**32, 300, dtype="uint32")
    b[:200] = a[:200]
    df = spark.createDataFrame([(minhash.low_bits(a), minhash.low_bits(b))], "a array<bigint>, b array<bigint>")

    def bits(signature):
        places = np.arange(300, dtype="uint64") << np.uint64(32)
        return mixed(mixed(signature.astype("uint64") | places)) & np.uint64(3)

    assert df.select(minhash.disagreements(df.a, df.b, 10)).first()[0] == int((bits(a) != bits(b)).sum())
    assert minhash.most_disagreements(300, 75) == 86


def test_cells_find_all_linked_labels():
    rng = np.random.default_rng(3)
    pool = np.sort(rng.integers(0, 2**63, 400, dtype="uint64"))
    rows = [(int(rng.integers(2)), n, n // 2, np.unique(np.concatenate([pool[n // 9 * 40 : n // 9 * 40 + 40], rng.choice(pool, rng.integers(3, 20))]))) for n in range(60)]
    for blocks in (rows, [(0, *r[1:]) for r in rows]):
        wanted = {(a[2], b[2]) for a in blocks for b in blocks if (a[0] != b[0] or blocks[0][0] == blocks[-1][0] == 0 and len({r[0] for r in blocks}) == 1) and a[2] != b[2] and 4 * len(np.intersect1d(a[3], b[3])) >= 3 * len(np.union1d(a[3], b[3]))}
        label = {r[1]: r[2] for r in blocks}
        top = {r[2]: r[2] for r in blocks}

        def find(x):
            while top[x] != x:
                x = top[x]
            return x

        links = minhash.cell_links(blocks, 75)
        assert all((label[a], label[b]) in wanted or (label[b], label[a]) in wanted for a, b in links) and wanted
        for a, b in links:
            top[find(label[a])] = find(label[b])
        assert all(find(x) == find(y) for x, y in wanted) and len(links) < len(top)


def test_a_band_larger_than_a_cell(spark, monkeypatch):
    """Variants of one text, many of them below the threshold to most others, in several cells a band."""
    monkeypatch.setattr(minhash, "CELL_ROWS", 5)
    rng = random.Random(9)
    rows = list(enumerate(family(rng, [f"w{j}" for j in range(100)], 60, 9)))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), star_rounds=0).collect()}
    assert got == components(sets_of(rows))


def test_links_grow_with_the_labels_of_a_band(spark, monkeypatch):
    """One band of mutually linked labels in many blocks: one link a label inside blocks, then one for every two blocks of a span."""
    monkeypatch.setattr(minhash, "CELL_ROWS", 4)
    monkeypatch.setattr(minhash, "SPAN", 4)
    handed, merge = [], minhash.merged

    def counted(labels, links):
        handed.append(links.count())
        return merge(labels, links)

    monkeypatch.setattr(minhash, "merged", counted)
    text = bytearray(b" ".join(b"w%d" % i for i in range(60)))
    for number in (64,):
        handed.clear()
        rows = spark.createDataFrame([(1, n) for n in range(number)], "key bigint, node bigint")
        texts = spark.createDataFrame([(n, text + b" own%d" % n) for n in range(number)], "node bigint, text binary")
        labels = rows.select("node", rows.node.alias("label"))
        merged = minhash.tournament(rows, labels, texts, 75, 5)
        assert {r.label for r in merged.collect()} == {0}
        assert sum(handed) < number + 16 * 2


def test_an_id_with_several_texts(spark):
    one, two = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    df = spark.createDataFrame([(1, one), (1, two), (2, two), (2, two + " c"), (3, None), (3, "")], "doc_id bigint, text string")
    found = sorted(map(tuple, minhash.near_duplicates(df, deviations=None).collect()), key=str)
    assert found == sorted([(1, 26, 1, True), (1, 26, 1, True), (2, 26, 1, False), (2, 27, 1, False), (3, 0, 3, True), (3, 0, 3, True)], key=str)
    assert sorted(map(tuple, minhash.drop_near_copies(df).collect()), key=str) == sorted([(1, one), (1, two), (3, None), (3, "")], key=str)


def test_pairs_just_above_the_threshold_are_found(spark):
    """Pairs of similarity 0.75 to 0.77, through the whole operator with its filter."""
    rows = []
    for i in range(300):
        words = [f"p{i}_{j}" for j in range(104)]
        other = list(words)
        other[7], other[50], other[90 if i % 2 else 101] = "x", "y", "z"  # 15 or 13 of 100 shingles change
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    sets = sets_of(rows)
    near = [i for i in range(300) if 100 * len(sets[2 * i] & sets[2 * i + 1]) >= 75 * len(sets[2 * i] | sets[2 * i + 1])]
    assert len(near) > 100
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), star_rounds=0).collect()}
    assert all((got[2 * i + 1] == 2 * i) == (i in set(near)) for i in range(300))


def test_filter_keeps_short_sets_at_the_threshold():
    """Sets of three and four shingles, three of them common: without mixed bits more than 1 % were dropped."""
    rng = np.random.default_rng(12)
    signer, most = minhash.MinMax(minhash.BANDS, minhash.BAND_VALUES), minhash.most_disagreements(minhash.BANDS * minhash.BAND_VALUES, 75)

    def bits(found):
        return np.array(minhash.low_bits(signer.signature(found)), "int64").view("uint8")

    for _ in range(2000):
        found = rng.integers(0, 2**64, 4, dtype="uint64")
        differ = np.unpackbits(bits(found) ^ bits(found[1:])).reshape(-1, 2)
        assert differ.any(1).sum() <= most
