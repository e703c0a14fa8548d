import random
import re
import string
import zlib
from collections import Counter

from odd_rows import no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from statforge.llm import spelling

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def edits_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def words_of(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def expected(words):
    near = {w: [v for v in words if edits_one(w, v)] for w in words}
    best = {w: min(near[w], key=lambda v: (-words[v], v), default=None) for w in words}
    form = {w: v if v and words[v] >= 5 * words[w] else None for w, v in best.items()}
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def made_words(rng, number):
    base = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(6, 9))) for _ in range(number)]
    out = set(base)
    for w in base:
        at = rng.randrange(len(w))
        out |= {w[:at] + w[at + 1 :], w[:at] + "z" + w[at:], w[:at] + "ÿ" + w[at + 1 :], w[::-1], w + w[-1]}
    return [w for w in out if len(w) >= 6]


def test_groups_equal_brute_force(spark):
    rng = random.Random(4)
    words = {w: rng.choice([5, 6, 30, 160, 900]) for w in made_words(rng, 120)}
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    found = sorted(map(tuple, spelling.variant_groups(df).collect()), key=str)
    wanted = expected(words)
    assert found == wanted
    assert any(r != f for _, f, r, *_ in wanted if f)


def test_fewer_parts_lose_nothing(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(w, 5) for w in made_words(rng, 60)], "word string, n bigint")
    pairs = [sorted(map(tuple, spelling.near_pairs(df, parts).select("a", "b").collect())) for parts in (3, 8)]
    words = [r.word for r in df.collect()]
    assert pairs[0] == pairs[1] == sorted((a, b) for a in words for b in words if a < b and edits_one(a, b))


def test_a_pair_at_distance_two_shares_a_signature(spark):
    row = spark.range(1).select(spelling.signatures(F.lit("letters")).alias("a"), spelling.signatures(F.lit("lexters")).alias("b")).first()
    assert len(row.a) == 28 and set(row.a) & set(row.b)


def test_words_of_documents(spark, odd_docs, no_docs):
    rng = random.Random(6)
    pool = made_words(rng, 30)
    rows = [(i if i % 50 else None, " ".join(rng.choice(pool).title() for _ in range(60)) + rng.choice(["", " É-É", "\n42x"])) for i in range(300)]
    rows += [(7, None), (8, ""), (9, "short words")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = {r.word: r.n for r in spelling.vocabulary(df).collect()}
    assert found == words_of(rows)
    assert sorted(map(tuple, spelling.spelling_variants(df).collect()), key=str) == expected(words_of(rows))
    odd = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted(map(tuple, spelling.spelling_variants(odd_docs).collect()), key=str) == expected(words_of(odd))
    assert spelling.spelling_variants(no_docs).count() == 0
