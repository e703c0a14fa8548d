import math
from collections import Counter

from odd_rows import no_docs, odd_docs  # noqa: F401
from statforge.llm import mixing


def docs_of(spark, sizes):
    rows = [(n, "x" * 10, s) for n, s in enumerate(s for s, k in sizes.items() for _ in range(k))]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def test_shares_meet_their_targets(spark):
    docs = docs_of(spark, {"a": 6000, "b": 1500, None: 1500})
    rates = {r.source: r for r in mixing.rates(docs, 0.5, 1.0).collect()}
    assert math.isclose(rates["a"].weight, 2 * rates["b"].weight) and math.isclose(rates["a"].rate, 0.75) and math.isclose(rates[None].rate, 1.5)
    copies = Counter(r.source for r in mixing.poisson_mix(docs).select("source").collect())
    for source, r in rates.items():
        wanted = r.rate * r.size / 10
        assert abs(copies[source] - wanted) < 5 * wanted**0.5


def test_counts_are_poisson(spark):
    docs = docs_of(spark, {"a": 20000})
    counts = Counter(Counter(r.doc_id for r in mixing.poisson_mix(docs, epochs=2.0).select("doc_id").collect()).values())
    for k in range(1, 7):
        p = math.exp(-2) * 2**k / math.factorial(k)
        assert abs(counts[k] - 20000 * p) < 5 * (20000 * p) ** 0.5


def test_large_means_are_sums_of_draws(spark):
    weights = spark.createDataFrame([("rare", 0.5), ("b", 0.5)], "source string, weight double")
    docs = docs_of(spark, {"rare": 10, "b": 8000, "left": 5})
    copies = Counter(r.source for r in mixing.poisson_mix(docs, weights=weights).select("source").collect())
    wanted = 8015 / 2
    assert abs(copies["rare"] - wanted) < 6 * wanted**0.5 and copies["left"] == 0


def test_same_seed_same_result_and_other_order(spark):
    docs = docs_of(spark, {"a": 500})
    one, two, other = (mixing.poisson_mix(docs, seed=s).select("doc_id", "copy", "shuffle_key").collect() for s in (1, 1, 2))
    assert sorted(one) == sorted(two) and sorted(one) != sorted(other)
    ids = [r.doc_id for r in one]
    assert ids != sorted(ids)


def test_rows_without_ids_are_drawn_apart(spark):
    docs = spark.createDataFrame([(None, f"text {i}", "a") for i in range(4000)], "doc_id bigint, text string, source string")
    out = mixing.poisson_mix(docs).select("text", "shuffle_key").collect()
    assert abs(len(out) - 4000) < 5 * 4000**0.5
    assert len({r.shuffle_key for r in out}) == len(out) and len({r.text for r in out}) < 3000


def test_odd_rows(odd_docs, no_docs):
    out = mixing.poisson_mix(odd_docs, epochs=3.0)
    assert out.columns == [c for c in odd_docs.columns if c != "rate"] + ["rate", "copies", "copy", "shuffle_key"]
    rows = out.collect()
    twice = [r.copy for r in rows if r.doc_id == 2]
    assert len(twice) == 2 * len(set(twice))
    assert mixing.poisson_mix(no_docs).count() == 0
