"""Byte-pair encoding and decoding with a vocabulary of word pieces, by a contiguous array of ranks.

A text is cut at the vocabulary's special tokens, normalised and split into words as its tokenizer file says. A word's bytes are its first parts. Its part boundaries,
the parts' ids and the rank of every two neighbours lie in contiguous arrays: the smallest rank is looked for by a scan, the boundary between its two parts is deleted, and the ranks
on both sides are looked up anew, until no two neighbours have a rank. A scan of so short an array costs less than any queue. Words of more than
``SHORT`` bytes would make that quadratic, so they take the same steps in the same order from a heap over linked neighbours.

Words repeat, so each worker keeps the ids of those it met, up to a bound. Texts with characters on which Unicode versions differ are normalised and split by the
tokenizer file's own rules (``tokenizers``) instead of the equal ones here; the merges are always done here.

Defined results: NULL and empty text, and text of white space only, have no ids and decode to empty text. Decoding joins tokens by one space, as the tokenizer file names no decoder;
ids outside the vocabulary are passed over. Rows that repeat an id and rows with a NULL id are encoded each. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from statforge.llm.shared import map_columns

MODEL = public_tokenizers.path("word_bpe_49k.json")
SHORT = 96
_NONE = 1 << 30
_MOST_WORDS, _LONGEST_KEPT, _ROWS = 200_000, 64, 512
# Fixed values of the tokenizer file: how words are split, and the mark of a word's end.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
#: Where letters were added lately, so that two libraries may know different ones.
_RECENT = regex.compile("[ᲀ-᳿Ꙁ-꯿\U00010000-\U0010ffff]")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in set(plain) else chr(next(others)) for b in range(256)]


def merge_short(parts: list[int], ranks: dict[int, int], made: list[int]) -> tuple[list[int], list[int]]:
    """The ids that ``parts`` become, and where each begins among them. ``ranks`` has the rank of two ids under ``left << 32 | right``."""
    parts, bounds = list(parts), list(range(len(parts)))
    near = [ranks.get(a << 32 | b, _NONE) for a, b in zip(parts[:-1], parts[1:], strict=True)]
    while near:
        least = min(near)
        if least == _NONE:
            break
        at = near.index(least)  # the leftmost of equal ranks
        parts[at] = made[least]
        del parts[at + 1], bounds[at + 1], near[at]
        if at < len(near):
            near[at] = ranks.get(made[least] << 32 | parts[at + 1], _NONE)
        if at:
            near[at - 1] = ranks.get(parts[at - 1] << 32 | made[least], _NONE)
    return parts, bounds


def merge_long(parts: list[int], ranks: dict[int, int], made: list[int]) -> tuple[list[int], list[int]]:
    """As ``merge_short``, in time n log n."""
    parts, count = list(parts), len(parts)
    after, before = list(range(1, count + 1)), list(range(-1, count - 1))
    heap = [(rank, i) for i in range(count - 1) if (rank := ranks.get(parts[i] << 32 | parts[i + 1], _NONE)) != _NONE]
    heapq.heapify(heap)
    while heap:
        rank, at = heapq.heappop(heap)
        following = after[at] if parts[at] >= 0 else count
        if following == count or ranks.get(parts[at] << 32 | parts[following], _NONE) != rank:
            continue  # one of the two has been merged since
        parts[at], parts[following] = made[rank], -1
        after[at] = after[following]
        if after[at] < count:
            before[after[at]] = at
        for left in (before[at], at):
            if left >= 0 and after[left] < count and (fresh := ranks.get(parts[left] << 32 | parts[after[left]], _NONE)) != _NONE:
                heapq.heappush(heap, (fresh, left))
    bounds = [i for i in range(count) if parts[i] >= 0]
    return [parts[i] for i in bounds], bounds


class Encoder:
    """The vocabulary of a tokenizer file, with the ids of words met before."""

    def __init__(self, model: str = MODEL):
        with open(model, encoding="utf-8") as file:
            described = json.load(file)
        vocabulary = described["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in described["model"]["merges"]]
        self.ranks = {vocabulary[a] << 32 | vocabulary[b]: rank for rank, (a, b) in reversed(list(enumerate(pairs)))}
        self.made = [vocabulary[a + b] for a, b in pairs]
        self.first = [vocabulary[c] for c in byte_characters()]
        self.last = [vocabulary[c + WORD_END] for c in byte_characters()]
        self.special = {token["content"]: token["id"] for token in described["added_tokens"]}
        tokens = {i: token for token, i in vocabulary.items()} | {i: token for token, i in self.special.items()}
        self.tokens = [tokens.get(i) for i in range(max(tokens) + 1)]
        self.rules = Tokenizer.from_file(model)
        self.white, self.word = regex.compile(r"\s+"), regex.compile(WORD_PATTERN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.bytes_of = {c: b for b, c in enumerate(byte_characters())}
        # Words met of late, and those met before them: frequent words are never forgotten.
        self.known: dict[str, bytes] = {}
        self.former: dict[str, bytes] = {}

    def words(self, text: str) -> Iterator[str]:
        """The words of a text without special tokens."""
        if _RECENT.search(text):
            normal = self.rules.normalizer.normalize_str(text)
            for shown, _ in self.rules.pre_tokenizer.pre_tokenize_str(normal):
                yield bytes(self.bytes_of[c] for c in shown).decode()
        else:
            # Letters are lowered one by one: only this letter would look at its neighbours.
            yield from self.word.findall(self.white.sub(" ", unicodedata.normalize("NFC", text)).replace("Σ", "σ").lower())

    def merged(self, word: str) -> tuple[list[int], list[int]]:
        """Ids of a word, and the byte where each begins."""
        raw = word.encode()
        parts = [self.first[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        return (merge_short if len(parts) <= SHORT else merge_long)(parts, self.ranks, self.made)

    def encode(self, text: str | None) -> np.ndarray:
        ids: list[bytes] = []
        known = self.known
        for piece in self.cut.split(text or ""):
            if piece in self.special:
                ids.append(np.array([self.special[piece]], "<u4").tobytes())
                continue
            for word in self.words(piece):
                found = known.get(word)
                if found is None:
                    found = self.former.get(word) or array("I", self.merged(word)[0]).tobytes()
                    if len(known) >= _MOST_WORDS:
                        self.former, self.known = known, {}
                        known = self.known
                    if len(word) <= _LONGEST_KEPT:
                        known[word] = found
                ids.append(found)
        return np.frombuffer(b"".join(ids), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        known = ids[ids < len(self.tokens)].tolist()
        return " ".join(filter(None, map(self.tokens.__getitem__, known)))


@functools.lru_cache(2)
def encoder(model: str) -> Encoder:
    """The vocabulary, loaded once a worker."""
    return Encoder(model)


def encode_documents(docs: DataFrame, model: str = MODEL, with_decoded: bool = False) -> DataFrame:
    """(doc_id, ids) for every row: ids are little-endian unsigned 32-bit numbers, one after another.

    ``with_decoded`` adds the text that ``decode_documents`` gives for them, from the same workers.
    """

    def work(doc_ids, texts):
        coder = encoder(model)
        ids = [coder.encode(text) for text in texts]
        decoded = {"decoded": [coder.decode(i) for i in ids]} if with_decoded else {}
        return {"doc_id": doc_ids, "ids": [i.tobytes() for i in ids]} | decoded

    return map_columns(docs.select(F.col("doc_id").cast("bigint"), "text"), "doc_id bigint, ids binary" + ", decoded string" * with_decoded, work, _ROWS)


def decode_documents(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, ids, decoded) for every row (doc_id, ids) of ``encode_documents``."""

    def work(doc_ids, packed):
        coder = encoder(model)
        return {"doc_id": doc_ids, "ids": packed, "decoded": [coder.decode(np.frombuffer(p or b"", "<u4")) for p in packed]}

    return map_columns(encoded.select("doc_id", "ids"), "doc_id bigint, ids binary, decoded string", work, _ROWS)


def token_digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the encoded and decoded rows."""
    return encode_documents(docs, model, with_decoded=True).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
