import os
import zlib

import numpy as np
import pytest

from odd_rows import no_docs, odd_docs  # noqa: F401
from statforge.llm import quality, toxicity
from statforge.llm.linear import dual_descent, probabilities
from statforge.llm.shared import table

SF_DIR = "/root/testdata/sf0.01"
given = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not on this machine")


def held_out_scores(spark, score, label):
    labels = {r.doc_id: r[label] for r in table(spark, SF_DIR, "labels").collect()}
    rows = score(table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")).collect()
    assert len(rows) == table(spark, SF_DIR, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    own = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    return tuple(np.array(x) for x in zip(*own, strict=True))


def auc(score, label):
    good, bad = score[label == 1], score[label == 0]
    return float(((good[:, None] > bad) + 0.5 * (good[:, None] == bad)).mean())


@given
def test_quality_on_held_out_rows(spark):
    score, predicted, label = held_out_scores(spark, quality.score_quality, "quality")
    assert auc(score, label) > 0.97 and (predicted == label).mean() > 0.93
    assert ((score >= 0.3) == predicted).all()


@given
def test_toxicity_on_held_out_rows(spark):
    score, predicted, label = held_out_scores(spark, toxicity.score_toxicity, "toxic")
    assert auc(score, label) > 0.85 and (predicted == label).mean() > 0.9
    assert ((score >= 0.5) == predicted).all()


@pytest.mark.parametrize("score, label", [(quality.score_quality, "quality"), (toxicity.score_toxicity, "toxic")])
def test_odd_rows_and_missing_labels(spark, odd_docs, no_docs, score, label):
    schema = f"doc_id bigint, {label} int, text string"
    none = spark.createDataFrame([], schema)
    assert {r.score for r in score(odd_docs, none).collect()} == {0.5}
    ids = [i for i in range(1, 8) if zlib.crc32(str(i).encode()) % 5]
    labels = spark.createDataFrame([(i, i % 2, None) for i in ids] + [(None, 1, "x"), (ids[0], None, "x"), (ids[0], ids[0] % 2, None), (99, 1, None), (ids[1], 7, None)], schema)
    rows = score(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert score(no_docs, labels).count() == 0


def test_drop_toxic_keeps_columns(spark, odd_docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    kept = toxicity.drop_toxic(odd_docs, labels, threshold=0.6)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert toxicity.drop_toxic(odd_docs, labels, threshold=0.5).count() == 0


def test_dual_descent_reaches_the_optimum():
    """Duality gap of a small problem, and both sides apart."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(1, 1, (60, 4)), rng.normal(-1, 1, (60, 4))])
    sides = np.repeat([1.0, -1.0], 60)
    rows = [(np.arange(4), v) for v in x]
    most = np.full(120, 0.5)
    w, bias = dual_descent(rows, sides, most, 4, 400, 1)
    margins = sides * (x @ w + bias)
    primal = (w @ w + bias**2) / 2 + 0.5 * np.maximum(0, 1 - margins).sum()
    worse = min(
        ((w + d) @ (w + d) + (bias + e) ** 2) / 2 + 0.5 * np.maximum(0, 1 - sides * (x @ (w + d) + bias + e)).sum()
        for d, e in ((rng.normal(0, 0.05, 4), rng.normal(0, 0.05)) for _ in range(200))
    )
    assert primal <= worse + 1e-3 and (margins > 0).mean() > 0.9


def test_probabilities_follow_margins():
    margins = np.linspace(-2, 2, 400)
    slope, shift = probabilities(margins, (margins > 0.5).astype(float))
    assert slope > 1 and abs(-shift / slope - 0.5) < 0.1


def test_label_model_learns_from_correlated_voters():
    """Two good voters, a copy of a poor one: the copy must not outvote the good ones."""
    rng = np.random.default_rng(4)
    truth = rng.random(4000) < 0.2

    def voter(accuracy):
        right = rng.random(4000) < accuracy
        return np.where(truth == right, 1, -1)

    poor = voter(0.6)
    votes = np.stack([voter(0.9), voter(0.85), poor, poor, poor, np.where(rng.random(4000) < 0.5, 0, voter(0.8))], 1)
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = toxicity.LabelModel(patterns, counts, counts, np.bincount(at, weights=truth & (rng.random(4000) < 0.9)))
    assert ((model.posterior[at] > 0.5) == truth).mean() > 0.9
    assert {frozenset((j, int(p))) for j, p in enumerate(model.parents) if p >= 0} <= {frozenset(e) for e in ((2, 3), (3, 4), (2, 4))}


@pytest.mark.parametrize("anchor", [0.0, 0.1])
def test_label_model_learns_from_documents_without_labels(anchor):
    """A voter is silent on all labelled documents; how good it is, also where it alone speaks, follows from the others' votes."""
    rng = np.random.default_rng(5)
    number = 6000
    truth, known = rng.random(number) < 0.3, np.arange(number) < 400

    def voter(accuracy, silent):
        return np.where(rng.random(number) < silent, 0, np.where(truth == (rng.random(number) < accuracy), 1, -1))

    votes = np.stack([voter(0.9, 0.3), voter(0.85, 0.3), voter(0.8, 0.3), np.where(known, 0, voter(0.95, 0.1))], 1)
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    labelled, toxic = np.bincount(at, weights=known, minlength=len(counts)), np.bincount(at, weights=known & truth, minlength=len(counts))
    model = toxicity.LabelModel(patterns, counts, labelled, toxic, anchor=anchor)
    posterior = {tuple(p): x for p, x in zip(patterns.tolist(), model.posterior, strict=True)}
    alone = (0, 0, 0, 1), (0, 0, 0, -1)
    assert not any(labelled[patterns.tolist().index(list(p))] for p in alone)
    assert posterior[alone[0]] > 0.75 and posterior[alone[1]] < 0.1


def test_votes_of_all_documents_are_counted(spark, odd_docs, no_docs):
    zeros = np.zeros(toxicity._SIZE)
    voters = spark.sparkContext.broadcast(toxicity.Voters(zeros, zeros))
    assert sum(r["count"] for r in toxicity.vote_patterns(odd_docs, voters).collect()) == odd_docs.count()
    assert toxicity.vote_patterns(no_docs, voters).count() == 0


def test_a_lexicon_hit_counts_by_its_share_of_the_words():
    evidence = toxicity.Evidence()
    toxic, clean = np.zeros(toxicity._SIZE), np.zeros(toxicity._SIZE)
    toxic[evidence.of("zonk")], clean[evidence.of("other")] = 10, 1000
    voters = toxicity.Voters(toxic, clean)
    short, long = "zonk and more", "zonk " + " ".join(f"w{i}x" for i in range(1000))
    assert voters.votes(evidence.of(short), toxicity.traits(short))[0] == 1
    assert voters.votes(evidence.of(long), toxicity.traits(long))[0] == 0


def test_indicators_tell_repetition_from_text():
    grams = quality.Indicators()
    plain, again = grams.of("one two three four five"), grams.of("one one one one one")
    assert len(grams.of(None)) == len(grams.of(" ")) == 0 and set(again.tolist()) - set(plain.tolist())
