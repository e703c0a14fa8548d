import hashlib
import random
import string
import zlib
from collections import defaultdict

import pytest
from odd_rows import no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from statforge.llm import merkle

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def climb(levels, at, folded):
    proof = ""
    for level in levels[:-1]:
        run = level[at // 16 * 16 : at // 16 * 16 + 16]
        i = at % 16
        proof += "".join(run[:i] + run[i + 1 :])
        folded, at = sha(*run[:i], folded, *run[i + 1 :]), at // 16
    return folded, proof


def expected(rows, change):
    groups = defaultdict(list)
    for r in rows:
        text = r["text"]
        if change and text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
            text = text.translate(LOWER)
        groups[r["source"]].append(((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])), leaf(r, text), r["doc_id"]))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([key[2] for key, _, _ in sorted(groups[s])]) for s in order]
    top = tree([t[-1][0] for t in trees])
    out = []
    for number, s in enumerate(order):
        for at, (key, now, doc_id) in enumerate(sorted(groups[s], key=lambda x: x[0])):
            folded, proof = climb(trees[number], at, now)
            folded, more = climb(top, number, folded)
            out.append((doc_id, key[2], trees[number][-1][0], top[-1][0], sha(proof, more), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def found(df, change):
    return sorted(map(tuple, merkle.check_manifest(df, merkle.tampered(df) if change else None).collect()), key=str)


def test_equals_brute_force(spark):
    rng = random.Random(2)
    sources = [None, "", "one", "hot", *(f"s{i}" for i in range(20)), "é"]
    rows = [
        {"doc_id": i, "source": "hot" if i < 700 else rng.choice(sources[4:]), "lang": rng.choice([None, "en", ""]), "n_chars": rng.choice([None, 7]), "text": rng.choice([None, "", f"Text {i}", "Ää"])}
        for i in range(1000)
    ]
    rows += [{"doc_id": 5000 + i, "source": s, "lang": "en", "n_chars": 1, "text": "Alone"} for i, s in enumerate(sources[:3])]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(5)
    wanted = expected(rows, True)
    assert found(df, True) == wanted
    assert {r[-1] for r in wanted} == {True, False}


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [r.asDict() for r in odd_docs.collect()]
    assert found(odd_docs, True) == expected(rows, True)
    assert merkle.check_manifest(no_docs, merkle.tampered(no_docs)).count() == 0


@pytest.mark.parametrize("count", [1, 17])
def test_widths_of_one_source(spark, count):
    rows = [{"doc_id": i, "source": "s", "lang": None, "n_chars": None, "text": f"T{i}"} for i in range(count)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    assert found(df, False) == expected(rows, False)


def test_crowded_nodes_are_copied(spark, monkeypatch):
    monkeypatch.setattr(merkle, "_PER_COPY", 2)
    rows = [{"doc_id": i, "source": f"s{i % 3}" if i < 40 else "hot", "lang": None, "n_chars": None, "text": f"T{i}"} for i in range(500)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    assert found(df, True) == expected(rows, True)


def test_row_limit_is_put_back(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit", None)
    df = spark.createDataFrame([(1, "s", "en", 1, "Text")], SCHEMA)
    assert merkle.check_manifest(df, F.lit("other")).first().verified is False
    assert spark.conf.get("spark.sql.cteRecursionRowLimit", None) == before
