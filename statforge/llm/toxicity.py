"""Toxicity scores by weak supervision.

Many weak voters look at a document: lexicons of words, word beginnings and word ends, a list of insults, and patterns of
address and tone. A voter says toxic (1), clean (-1) or nothing (0). A generative label model explains the votes by an unseen true label:
expectation maximisation estimates how each voter votes on toxic and on clean documents. Voters that share evidence are not independent, so
the model also has correlations: a forest over the voters, found by their mutual information given the label,
in which a vote depends on the label and on one other vote. A voter that says nothing is evidence only
beside a related voter that spoke. The share of toxic documents is taken from the labels. The model's posterior labels then train a linear classifier on the
documents' word features, which scores every document.

All documents vote, with or without a label, and the label model is fitted to their votes: one scan that counts the few thousand patterns of votes. The lexicons, and
the voters' records that the label model starts from, come from labelled documents outside the held-out fold; these records count ``anchor`` times in the
model's later tables, beside all documents (0: they are a start only).

Defined results: NULL and empty text get the score of no evidence. A label other than 0 or 1 is ignored; of several labels of a document the least counts.
Without training rows of both labels the score is the smoothed share of toxic ones. Repeated rows are scored each.
A NULL id is not held out. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import string
import zlib
from array import array
from collections.abc import Callable
from functools import cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statforge.llm.linear import Model, bucket_counts, fit, in_shards
from statforge.llm.quality import scored
from statforge.llm.shared import checkpointed, labelled_sample, map_columns

BITS = 18  # buckets of one kind of feature
KINDS = ("word", "start4", "start5", "end4")
THRESHOLD = 0.5
_SIZE = len(KINDS) << BITS
_MOST_KEPT = 200_000
ANCHOR = 0.1
_MARKS = string.punctuation + "¿¡…–—„“”«»"

# Common insults.
INSULTS = frozenset(("idiot", "idiots", "idiotic", "moron", "morons", "moronic", "stupid", "dumb", "dumbass", "loser", "losers", "scum", "scumbag", "pathetic", "worthless", "trash", "garbage", "clown", "disgusting", "vermin", "filth", "filthy", "imbecile", "cretin", "bastard", "bastards", "asshole", "bitch", "shit", "fuck", "fucking", "retard", "retarded", "subhuman", "pig", "pigs", "hate"))
_ADDRESS = re.compile(r"\b(?:you|u|they)(?:'re| are| r)? (?:all )?(?:an? |such |so |nothing )")
_THREAT = re.compile(r"\b(?:kill|hurt|destroy|beat|burn) (?:you|them|him|her|yourself)\b|\bgo die\b|\bshut up\b")
# What every threat holds: texts without it needn't be searched.
_IN_THREATS = ("kill ", "hurt ", "destroy ", "beat ", "burn ", "go die", "shut up")
_SHOUTS = ("!!", "!?", "?!", "??")
TRAITS = ("insults", "address", "threat", "shout", "capitals")


_MASK, _BEGUN = (1 << BITS) - 1, zlib.crc32(b"^")


def buckets(word: str, crc32: Callable[..., int] = zlib.crc32) -> tuple[int, int, int, int]:
    """The buckets of a word, its beginnings of 4 and 5 characters (after ``^``) and its end of 4 (before ``$``), one of each kind.

    Texts have many words that no cache has seen, so this is most of the work: it is spelled out, and ASCII words are encoded once.
    """
    whole = word.encode()
    if len(whole) == len(word):
        start4, start5, end4 = whole[:4], whole[:5], whole[-4:]
    else:
        start4, start5, end4 = word[:4].encode(), word[:5].encode(), word[-4:].encode()
    return (
        crc32(whole) & _MASK,
        (1 << BITS) + (crc32(start4, _BEGUN) & _MASK),
        (2 << BITS) + (crc32(start5, _BEGUN) & _MASK),
        (3 << BITS) + (crc32(b"$", crc32(end4)) & _MASK),
    )


class Evidence(dict):
    """The word features of a text, as buckets: each kind has its own range."""

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) >= _MOST_KEPT:
            self.clear()
        word = token.strip(_MARKS)
        value = self[token] = buckets(word) if word else ()
        return value

    def of(self, text: str | None) -> np.ndarray:
        tokens = set((text or "").lower().split())
        found = set(chain.from_iterable(map(self.__getitem__, tokens)))
        return np.fromiter(found, "int32", len(found))


class _Insults(dict):
    """Whether a token is an insult, kept while there are not too many."""

    def __missing__(self, token: str) -> bool:
        if len(self) >= _MOST_KEPT:
            self.clear()
        value = self[token] = token.strip(_MARKS) in INSULTS
        return value


_is_insult = _Insults()


#: The row of a token of marks only: past all buckets.
_NOTHING = (_SIZE,) * len(KINDS)


class Rows(dict):
    """The word features and insults of many texts: tokens are rows of a table, so that a text's features are looked up and told apart at once.

    ``of`` gives the same set of buckets as ``Evidence``, ascending. The table is emptied between texts when it holds too many tokens.
    """

    def __init__(self):
        self._buckets, self._insults = array("i"), bytearray()

    def __missing__(self, token: str) -> int:
        row = self[token] = len(self)
        word = token.strip(_MARKS)
        self._buckets.extend(buckets(word) if word else _NOTHING)
        self._insults.append(word in INSULTS)
        return row

    def of(self, tokens: set[str]) -> tuple[np.ndarray, int]:
        """Distinct features of a text's distinct tokens, and how many of the tokens are insults."""
        if len(self) >= _MOST_KEPT:
            self.clear()
            self._buckets, self._insults = array("i"), bytearray()
        rows = np.fromiter(map(self.__getitem__, tokens), "int32", len(tokens))
        found = np.sort(np.frombuffer(self._buckets, "int32").reshape(-1, len(KINDS))[rows], axis=None)
        found = found[: np.searchsorted(found, _SIZE)]
        return found[np.diff(found, prepend=-1) != 0], int(np.frombuffer(self._insults, bool)[rows].sum())


@cache
def _letter_kinds() -> np.ndarray:
    """1 for letters and 2 for capitals, summed, by code point below 65,536."""
    return np.array([c.isalpha() + 2 * c.isupper() for c in map(chr, range(1 << 16))], "uint8")


def _capitals(text: str) -> tuple[int, int]:
    """How many capitals and how many letters a text has."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "uint32")
    if len(codes) and codes.max() >> 16:
        # By distinct character, as counting one is far faster than asking each.
        chars = set(text)
        uppers, letters = (sum(map(text.count, filter(kind, chars))) for kind in (str.isupper, str.isalpha))
        return uppers, letters
    neither, letters, marks, both = np.bincount(_letter_kinds()[codes], minlength=4).tolist()
    return marks + both, letters + both


def traits(text: str, low: str | None = None, insults: int | None = None) -> list[int]:
    """What the pattern voters look at: how many insults, and whether (1) there is an address beside them, a threat, a shout, mostly capitals.

    ``low`` is the text in lower case and ``insults`` the number of its distinct tokens that are insults, where the caller has them.
    """
    low = text.lower() if low is None else low
    insults = sum(map(_is_insult.__getitem__, set(low.split()))) if insults is None else insults
    uppers, letters = _capitals(text)
    return [
        insults,
        int(insults > 0 and _ADDRESS.search(low) is not None),
        int(any(part in low for part in _IN_THREATS) and _THREAT.search(low) is not None),
        int(any(pair in text for pair in _SHOUTS)),
        int(2 * uppers > (letters or 1)),
    ]


class Voters:
    """Votes from features and traits. A lexicon is a mask over buckets; its wide form decides who is clean."""

    def __init__(self, toxic: np.ndarray, clean: np.ndarray, strict: float = 3.5, wide: float = 1.5, least: float = 3, rare: float = 0.004):
        self.rare = rare
        ratio = np.log((toxic + 0.1) / (toxic.sum() + 1)) - np.log((clean + 0.5) / (clean.sum() + 1))
        self.strict = (ratio >= strict) & (toxic >= least)
        self.wide = (ratio >= wide) & (toxic >= least)

    def votes(self, features: np.ndarray, marks: list[int]) -> list[int]:
        kinds = features >> BITS
        strict, wide = (np.bincount(kinds[mask[features]], minlength=len(KINDS)) for mask in (self.strict, self.wide))
        sizes = np.bincount(kinds, minlength=len(KINDS))
        insults, address, threat, shout, capitals = marks
        out = []
        # One hit among hundreds of words says nothing: long texts have it by chance.
        for hits, size in zip(strict.tolist(), sizes.tolist(), strict=True):
            out += [1 if hits and hits >= self.rare * size else 0, 1 if hits > 2 else 0]
        out += [1 if insults else 0, 1 if insults > 1 else 0, 1 if address and insults else 0, 1 if threat else 0, 1 if shout else 0, 1 if capitals else 0]
        out += [-1 if not wide.any() else 0, -1 if not strict.any() and not insults else 0]
        share = strict[0] / max(1, int(sizes[0]))
        out.append(1 if share >= 0.01 else -1 if share < self.rare else 0)
        return out


class LabelModel:
    """P(label) and P(vote | label, vote of the parent voter), fitted to vote patterns.

    ``counts`` documents have each pattern, with or without a label; ``labelled`` of them have one, and ``toxic`` of those are labelled so.
    """

    def __init__(self, votes: np.ndarray, counts: np.ndarray, labelled: np.ndarray, toxic: np.ndarray, rounds: int = 60, least_information: float = 0.02, anchor: float = ANCHOR):
        self.votes, self.counts = votes + 1, counts.astype("float64")  # 0, 1, 2
        number = votes.shape[1]
        self.parents = np.full(number, -1)
        self.share = float(toxic.sum() / labelled.sum())
        # The first tables are the voters' records on the labels; later ones come from all documents, and the records count ``anchor`` times in them.
        self.labels = np.stack([labelled - toxic, toxic]).astype("float64")
        # The forest is found before any maximisation: without it, copies of one voter would outvote the others and draw the labels to them.
        self.parents = self._forest(self._posterior(self._tables(self.labels)), least_information)
        self.posterior = self._maximise(self._posterior(self._tables(self.labels)), rounds, anchor)

    def _above(self, j: int) -> np.ndarray:
        return self.votes[:, self.parents[j]] if self.parents[j] >= 0 else np.zeros(len(self.votes), int)

    def _tables(self, weights: np.ndarray) -> list[np.ndarray]:
        """For each voter P(vote | label, parent's vote), smoothed; ``weights`` are documents of each label by pattern."""
        out = []
        for j in range(self.votes.shape[1]):
            table = np.full((2, 3, 3), 0.5)
            for label in (0, 1):
                np.add.at(table[label], (self._above(j), self.votes[:, j]), weights[label])
            out.append(table / table.sum(2, keepdims=True))
        return out

    def _posterior(self, tables: list[np.ndarray]) -> np.ndarray:
        """P(toxic | votes) of each pattern."""
        odds = np.full(len(self.votes), np.log(self.share / (1 - self.share)))
        for j, table in enumerate(tables):
            above = self._above(j)
            said = np.log(table[1, above, self.votes[:, j]]) - np.log(table[0, above, self.votes[:, j]])
            # Silence tells something only next to a related voter that spoke.
            odds += np.where((self.votes[:, j] == 1) & ((self.parents[j] < 0) | (above == 1)), 0.0, said)
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))

    def _maximise(self, posterior: np.ndarray, rounds: int, anchor: float) -> np.ndarray:
        for _ in range(rounds):
            weights = np.stack([1 - posterior, posterior]) * self.counts + anchor * self.labels
            new = self._posterior(self._tables(weights))
            if np.abs(new - posterior).max() < 1e-6:
                return new
            posterior = new
        return posterior

    def _forest(self, posterior: np.ndarray, least: float) -> np.ndarray:
        """Parents along a spanning forest of the largest mutual information given the label."""
        number = self.votes.shape[1]
        edges = []
        for a in range(number):
            for b in range(a):
                joint = np.full((2, 3, 3), 1e-6)
                for label, weight in ((0, 1 - posterior), (1, posterior)):
                    np.add.at(joint[label], (self.votes[:, a], self.votes[:, b]), weight * self.counts)
                joint /= joint.sum()
                label = joint.sum((1, 2), keepdims=True)
                information = float((joint * np.log(joint * label / (joint.sum(2, keepdims=True) * joint.sum(1, keepdims=True)))).sum())
                if information >= least:
                    edges.append((information, a, b))
        parents, near, group = np.full(number, -1), [[] for _ in range(number)], list(range(number))
        for _, a, b in sorted(edges, reverse=True):
            if group[a] != group[b]:
                near[a].append(b)
                near[b].append(a)
                group = [group[a] if g == group[b] else g for g in group]
        seen = set()
        for root in range(number):
            stack = [(root, -1)] if root not in seen else []
            while stack:
                node, parent = stack.pop()
                if node not in seen:
                    seen.add(node)
                    parents[node] = parent
                    stack += [(other, node) for other in near[node]]
        return parents


def vote_patterns(docs: DataFrame, voters) -> DataFrame:
    """(votes, count): how many of all documents vote alike. The voters tell some 20,000 patterns apart at most."""

    def vote(texts):
        words, own, out = Rows(), voters.value, []
        for text in (text or "" for text in texts):
            low = text.lower()
            features, insults = words.of(set(low.split()))
            out.append(",".join(map(str, own.votes(features, traits(text, low, insults)))))
        return {"votes": out}

    return map_columns(docs.select("text"), "votes string", vote).groupBy("votes").agg(F.count("*").alias("count"))


def train(docs: DataFrame, labels: DataFrame, fit_rows: int, seed: int, anchor: float = ANCHOR) -> Model | float:
    """A classifier from at most ``fit_rows`` labelled documents outside the held-out fold, or a constant score; the label model is fitted to the votes of all of ``docs``."""

    def work(ids, texts, targets):
        evidence = Evidence()
        return {"doc_id": ids, "target": [float(y) for y in targets], "features": [evidence.of(t) for t in texts], "traits": [traits(t or "") for t in texts]}

    sample = labelled_sample(docs, labels, "toxic", fit_rows, seed)
    rows = checkpointed(in_shards(map_columns(sample, "doc_id bigint, target double, features array<int>, traits array<int>", work), seed), "toxicity")
    number, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("target"), F.lit(0.0))).first()
    if not 0 < toxic < number:
        return (toxic + 1) / (number + 2)
    voters = rows.sparkSession.sparkContext.broadcast(Voters(*bucket_counts(rows, _SIZE)))

    def vote(ids, features, marks, shards, targets):
        own = [voters.value.votes(np.array(f, "int32"), m) for f, m in zip(features, marks, strict=True)]
        return {"doc_id": ids, "features": features, "shard": shards, "target": targets, "votes": [",".join(map(str, v)) for v in own]}

    voted = checkpointed(map_columns(rows.select("doc_id", "features", "traits", "shard", "target"), "doc_id bigint, features array<int>, shard int, target double, votes string", vote), "votes")
    records = voted.groupBy("votes").agg(F.count("*").alias("labelled"), F.sum("target").alias("toxic"))
    patterns = vote_patterns(docs, voters).join(records, "votes", "left").fillna(0).orderBy("votes").toArrow()
    names = patterns["votes"].to_pylist()
    votes = np.array([list(map(int, name.split(","))) for name in names])
    model = LabelModel(votes, *(patterns[c].to_numpy() for c in ("count", "labelled", "toxic")), anchor=anchor)
    known = dict(zip(names, model.posterior.tolist(), strict=True))

    def label(ids, features, shards, votes):
        return {"doc_id": ids, "features": features, "shard": shards, "target": [known[v] for v in votes]}

    posterior = checkpointed(map_columns(voted.select("doc_id", "features", "shard", "votes"), "doc_id bigint, features array<int>, shard int, target double", label), "posterior")
    weighted, rest = bucket_counts(posterior, _SIZE)
    ratio = np.log((weighted + 0.1) / (weighted.sum() + 1)) - np.log((rest + 0.5) / (rest.sum() + 1))
    # Features that tell for toxic are scaled by how much; all others are small and alike, and stand for the document's length.
    scale = np.where((ratio > 1.5) & (weighted >= 3), ratio, 0.3)
    return fit(posterior, scale)


def score_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = 12_000, threshold: float = THRESHOLD, seed: int = 13, anchor: float = ANCHOR) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    ``fit_rows`` bounds the labelled sample behind lexicons and classifier; every document votes for the label model and is scored, over its whole text.
    """
    return scored(docs, train(docs, labels, fit_rows, seed, anchor), Evidence, threshold)


def drop_toxic(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns unchanged."""
    model = train(docs, labels, parameters.pop("fit_rows", 12_000), parameters.pop("seed", 13))
    threshold = parameters.pop("threshold", THRESHOLD)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def clean(texts):
        evidence, own = Evidence(), shared.value
        return texts.map(lambda t: (own.probability(evidence.of(t)) if isinstance(own, Model) else own) < threshold)

    return docs.where(clean(F.coalesce(F.col("text"), F.lit(""))))
