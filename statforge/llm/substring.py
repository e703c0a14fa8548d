"""Removal of repeated passages by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words. Its minimiser is the least of its ``GRAM``-word grams in the order of a hash. Consecutive
windows with one minimiser travel together, as one packed string of words (a super-k-mer), to the bucket of that
minimiser; equal windows have equal minimisers and so always meet. In its bucket a super-k-mer is sorted by minimiser, and only windows of
one minimiser are counted against each other, word by word, not by hash. What repeats goes back to its document as word intervals.

Grams that occur very often would fill a bucket. A first pass finds them (each task reports its frequent grams, and only these) and
they are passed over as minimisers, so that a window that holds anything rarer goes by that. Windows of frequent grams alone go to the bucket
of their own hash. Each task merges equal strings before it sends them. A string with more than ``INLINE`` places at once goes to its bucket
with the number of its places only. The places themselves bypass the bucket (one row per flush of a task, a group of its own), stay in a
written table, and meet what the bucket found about their string by a join with one match per row. So a bucket holds a few places
per string and flush, however many documents share a passage. Packed strings are compressed.

Defined results: words are runs of other characters than ASCII white space, unchanged; NULL text has none. Shorter documents than a window keep all words.
Rows that repeat id and text repeat each other's windows, and both lose them. A NULL id is an id like others. Extra columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statforge.llm.shared import PRIME, WordHashes, arrow_schema, checkpointed, map_columns, mixed, utf8

WINDOW, GRAM = 35, 5
BUCKET_BYTES = 16 << 20
_PLACES = (("ids", "int64"), ("hashes", "int64"), ("starts", "int32"))
INLINE = 8
_MOST_FREQUENT = 1 << 16
_FLUSH_BYTES = 32 << 20
_NO_ID = -(2**63)
_PASSED_OVER = np.uint64(2**64 - 1)
# Rows of a bucket >= 0 hold strings; ``flush`` and ``base`` say where the places of its strings with many begin. Rows of a bucket < 0 hold such places.
_PACKED = "bucket int, strings binary, keys binary, again binary, counts binary, ids binary, hashes binary, starts binary, flush binary, base int"
_INTERVALS = "doc_id bigint, text_hash bigint, begin int, end int"
# One of: an interval; with ``entry``, an interval of the string of that number in a flush, from the string's start; the places of a flush.
_FOUND = _INTERVALS + ", flush binary, entry int, counts binary, ids binary, hashes binary, starts binary"


def gram_hashes(words: list[bytes], hashes: WordHashes, gram: int) -> np.ndarray:
    ids = np.fromiter(map(hashes.__getitem__, words), "uint64", len(words))
    out = np.zeros(len(ids) - gram + 1, "uint64")
    for i in range(gram):
        out = out * PRIME + ids[i : len(ids) - gram + 1 + i]
    return mixed(out)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minima of ``width`` neighbours, by doubling."""
    reach, low = 1, values
    while 2 * reach <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def minimisers(grams: np.ndarray, window: int, gram: int, frequent: np.ndarray) -> np.ndarray:
    """The minimiser of every window. ``frequent`` (sorted) grams count only where there is nothing else; then a hash of the whole window stands in."""
    order = grams
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
        order = np.where(frequent[at] == grams, _PASSED_OVER, grams)
    least = sliding_minimum(order, window - gram + 1)
    alone = np.flatnonzero(least == _PASSED_OVER)
    if len(alone):
        whole = np.zeros(len(alone), "uint64")
        for i in range(window - gram + 1):
            whole = whole * PRIME + grams[alone + i]
        least = least.copy()
        least[alone] = mixed(whole)
    return least


def profile(texts: DataFrame, gram: int, share: float) -> DataFrame:
    """(gram, n): grams that make up ``share`` or more of their task's; row NULL, 0 has the number of all, row NULL, 1 the bytes."""
    target = arrow_schema(texts.sparkSession, "gram bigint, kind int, n bigint")

    def run(batches):
        hashes, held, total, size = WordHashes(), [], 0, 0
        known: dict[int, int] = {}

        def settle() -> None:
            found, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= max(2, share * sum(map(len, held)))
            for g, n in zip(found[often].view("int64").tolist(), counts[often].tolist(), strict=True):
                known[g] = known.get(g, 0) + n
            held.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                size += len(text)
                words = text.split()
                if len(words) >= gram:
                    held.append(gram_hashes(words, hashes, gram))
                    total += len(held[-1])
            if sum(map(len, held)) > 4_000_000:
                settle()
        if held:
            settle()
        rows = [(g, 2, n) for g, n in known.items()] + [(None, 0, total), (None, 1, size)]
        yield pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*rows, strict=True), target, strict=True)], schema=target)

    return texts.mapInArrow(run, "gram bigint, kind int, n bigint").groupBy("gram", "kind").agg(F.sum("n").alias("n"))


def _columns_of_places(entries: list[list[int]]) -> tuple[np.ndarray, ...]:
    places = np.array([x for e in entries for x in e[2:]], "int64").reshape(-1, 3)
    return tuple(np.ascontiguousarray(places[:, i]).astype(kind) for i, (_, kind) in enumerate(_PLACES))


class Sender:
    """Collects super-k-mers by bucket and packs them. Equal strings are held once, with all their places."""

    def __init__(self):
        self.size = 0
        self.held: defaultdict[int, dict[bytes, list[int]]] = defaultdict(dict)

    def add(self, line: bytes, doc_id: int, text_hash: int, spans) -> None:
        """Super-k-mers (bucket, key, again, first word, begin, end) of a document, the last two as bytes of ``line``."""
        size = 0
        for bucket, key, again, first, begin, end in spans:
            own = self.held[bucket]
            string = line[begin:end]
            entry = own.get(string)
            if entry is None:
                own[string] = [key, again, doc_id, text_hash, first]
                size += end - begin + 300
            else:
                entry[1] |= again
                entry += (doc_id, text_hash, first)
                size += 120  # three numbers of Python
        self.size += size

    def packed(self, target: pa.Schema) -> pa.RecordBatch:
        pack = zstandard.ZstdCompressor(level=3).compress
        rows, many, digest = [], [], hashlib.sha256()
        for bucket, found in self.held.items():
            entries = list(found.values())
            columns = (
                np.array([e[0] for e in entries], "uint64"),
                np.array([e[1] for e in entries], "uint8"),
                np.array([len(e) // 3 for e in entries], "int32"),
                *_columns_of_places([e for e in entries if len(e) // 3 <= INLINE]),
            )
            base = len(many)
            for string, entry in found.items():
                if len(entry) // 3 > INLINE:
                    digest.update(string + b"\n")
                    many.append(entry)
            rows.append((bucket, pack(b"\n".join(found)), *(pack(c.tobytes()) for c in columns), base))
        flush = None
        if many:
            # The name of a flush follows from what it holds, so a task that runs again gives the same one.
            columns = [c.tobytes() for c in (np.array([len(e) // 3 for e in many], "int32"), *_columns_of_places(many))]
            for c in columns:
                digest.update(c)
            flush = digest.digest()
        ends = [row[-1] for row in rows[1:]] + [len(many)]
        rows = [(*row[:-1], flush, row[-1]) if row[-1] < end else (*row[:-1], None, None) for row, end in zip(rows, ends, strict=True)]
        if many:
            rows.append((-1 - int.from_bytes(flush[:4]) // 2, None, None, None, *map(pack, columns), flush, None))
        self.size = 0
        self.held.clear()
        return pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*rows, strict=True), target, strict=True)], schema=target)


def super_kmers(texts: DataFrame, window: int, gram: int, buckets: int, frequent: np.ndarray) -> DataFrame:
    """Packed super-k-mers of rows (doc_id, text_hash, text), by bucket."""
    target = arrow_schema(texts.sparkSession, _PACKED)
    shared = texts.sparkSession.sparkContext.broadcast(frequent)  # at most 65,536 numbers

    def run(batches):
        hashes, sender = WordHashes(), Sender()
        for batch in batches:
            for doc_id, text_hash, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                words = text.as_py().split()
                if len(words) < window:
                    continue
                grams = gram_hashes(words, hashes, gram)
                least = minimisers(grams, window, gram, shared.value)
                firsts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
                keys, lasts = least[firsts], np.append(firsts[1:], len(least)) - 1 + window
                inside = np.sort(grams)
                # Only a gram that the document holds again can have equal windows inside one super-k-mer.
                again = (np.searchsorted(inside, keys, "right") - np.searchsorted(inside, keys) != 1) & (lasts - firsts > window)
                line = b" ".join(words)
                starts = np.zeros(len(words) + 1, "int64")
                np.cumsum(np.fromiter(map(len, words), "int64", len(words)) + 1, out=starts[1:])
                columns = (keys % np.uint64(buckets), keys, again.astype("uint8"), firsts, starts[firsts], starts[lasts] - 1)
                sender.add(line, doc_id, text_hash, zip(*(c.tolist() for c in columns), strict=True))
                if sender.size > _FLUSH_BYTES:
                    yield sender.packed(target)
        if sender.held:
            yield sender.packed(target)

    return texts.mapInArrow(run, _PACKED)


def _windows(string: bytes, window: int) -> list[bytes]:
    """All windows of a packed string."""
    words = string.split(b" ")
    starts = np.zeros(len(words) + 1, "int64")
    np.cumsum(np.fromiter(map(len, words), "int64", len(words)) + 1, out=starts[1:])
    return [string[a : b - 1] for a, b in zip(starts[: len(words) - window + 1].tolist(), starts[window:].tolist(), strict=True)]


def repeats_in_bucket(part: pa.Table, window: int, target: pa.Schema) -> pa.Table:
    """What a bucket holds more than once, as ``_FOUND``: word intervals of the places it has, and from a string's start for places elsewhere."""
    if part.column("bucket")[0].as_py() < 0:
        return _table({name: part.column(name) for name in ("flush", "counts", "ids", "hashes", "starts")}, len(part), target)
    unpack = zstandard.ZstdDecompressor().decompress
    rows = part.to_pylist()
    columns = [tuple(np.frombuffer(unpack(row[name]), kind) for name, kind in (("keys", "uint64"), ("again", "uint8"), ("counts", "int32"))) for row in rows]
    every = np.concatenate([keys for keys, _, _ in columns])
    held: dict[tuple[int, bytes], list] = {}
    seen, times = np.unique(every, return_counts=True)
    for row, (keys, again, counts) in zip(rows, columns, strict=True):
        # A string alone with its minimiser, in one place, can only repeat itself; most are such.
        useful = np.flatnonzero((times[np.searchsorted(seen, keys)] > 1) | (again > 0) | (counts > 1))
        if not len(useful):
            continue
        strings = unpack(row["strings"]).split(b"\n")
        places = [np.frombuffer(unpack(row[name]), kind) for name, kind in _PLACES]
        here = counts <= INLINE
        ends, after = np.cumsum(np.where(here, counts, 0)), np.cumsum(~here)
        for i, key, number, end in zip(useful.tolist(), keys[useful].tolist(), counts[useful].tolist(), ends[useful].tolist(), strict=True):
            own = tuple(p[end - number : end] for p in places) if number <= INLINE else (row["flush"], row["base"] + int(after[i]) - 1)
            held.setdefault((key, strings[i]), []).append((number, own))
    found, elsewhere = [], []
    for key, own in groupby(sorted(held), key=lambda x: x[0]):
        strings = [string for _, string in own]
        counts: dict[bytes, int] = {}
        for string in strings:
            number = sum(n for n, _ in held[key, string])
            for w in _windows(string, window):
                counts[w] = counts.get(w, 0) + number
        for string in strings:
            marks = [counts[w] > 1 for w in _windows(string, window)]
            at = 0
            for mark, run in groupby(marks):
                length = sum(1 for _ in run)
                if mark:
                    for number, places in held[key, string]:
                        if number <= INLINE:
                            ids, hashes, starts = places
                            found.append((ids, hashes, starts + at, starts + at + length - 1 + window))
                        else:
                            elsewhere.append((at, at + length - 1 + window, *places))
                at += length
    columns = zip(("doc_id", "text_hash", "begin", "end"), zip(*found, strict=True), strict=True) if found else ()
    own = {name: np.concatenate(c) for name, c in columns}
    more = dict(zip(("begin", "end", "flush", "entry"), zip(*elsewhere, strict=True), strict=True)) if elsewhere else {}
    return pa.concat_tables([_table(own, len(own.get("begin", ())), target), _table(more, len(elsewhere), target)])


def _table(columns: dict[str, object], length: int, target: pa.Schema) -> pa.Table:
    """A table of ``target`` where columns that are not given are NULL."""
    made = [c.cast(f.type) if isinstance(c := columns.get(f.name), pa.ChunkedArray) else pa.nulls(length, f.type) if c is None else pa.array(c, f.type) for f in target]
    return pa.Table.from_arrays(made, schema=target)


def merged_intervals(ids: np.ndarray, hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """The same words of the same documents in as few intervals as they need."""
    order = np.lexsort((begins, ids, hashes))
    ids, hashes, begins, ends = (x[order] for x in (ids, hashes, begins, ends))
    other = np.append(True, (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1]))
    # Documents one behind the other on one line, so that an end never reaches into the next.
    line = np.cumsum(other) << 32
    reach = np.maximum.accumulate(line + ends)
    firsts = np.flatnonzero(np.append(True, (line + begins)[1:] > reach[:-1]))
    lasts = np.append(firsts[1:], len(ids)) - 1
    return ids[firsts], hashes[firsts], begins[firsts], (reach[lasts] - line[lasts]).astype("int32")


def placed(found: DataFrame) -> DataFrame:
    """The word intervals of ``found`` (a written table of ``_FOUND``)."""
    # One row per flush on both sides, each bounded by what a flush holds.
    runs = found.where("entry IS NOT NULL").groupBy("flush").agg(F.sort_array(F.collect_list(F.struct("entry", "begin", "end"))).alias("runs"))
    places = found.where("counts IS NOT NULL").select("flush", "counts", "ids", "hashes", "starts")
    joined = places.join(runs, "flush").select("counts", "ids", "hashes", "starts", F.col("runs.entry").alias("entries"), F.col("runs.begin").alias("begins"), F.col("runs.end").alias("ends"))
    target = arrow_schema(found.sparkSession, _INTERVALS)

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in batch.to_pylist():
                counts, ids, hashes, starts = (np.frombuffer(unpack(row[name]), kind) for name, kind in (("counts", "int32"), *_PLACES))
                entries = np.array(row["entries"])
                sizes = counts[entries]
                at = np.arange(sizes.sum()) + np.repeat(np.cumsum(counts)[entries] - np.cumsum(sizes), sizes)
                begin, end = (starts[at] + np.repeat(np.array(row[name], "int32"), sizes) for name in ("begins", "ends"))
                merged = merged_intervals(ids[at], hashes[at], begin, end)
                whole = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(merged, target, strict=True)], schema=target)
                for first in range(0, len(whole), 10_000):
                    yield whole.slice(first, 10_000)

    return found.where("doc_id IS NOT NULL").select("doc_id", "text_hash", "begin", "end").unionByName(joined.mapInArrow(run, _INTERVALS))


def covered(n_words: int, begins: list[int] | None, ends: list[int] | None) -> np.ndarray:
    """Which words lie in an interval."""
    steps = np.zeros(n_words + 1, "int64")
    np.add.at(steps, np.array(begins or [], "int64"), 1)
    np.add.at(steps, np.array(ends or [], "int64"), -1)
    return np.cumsum(steps[:-1]) > 0


def repeated_intervals(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, text_hash, begin, end): word intervals covered by windows that start elsewhere, too. A NULL id is the least long."""
    spark = docs.sparkSession
    texts = _keyed(docs)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Bounded: a share of 1 / (2 * 65,536) leaves at most twice 65,536 grams a task.
    share = 1 / min(_MOST_FREQUENT, 16 * partitions)
    found = profile(texts.select("text"), gram, share / 2)
    totals = checkpointed(found, "grams")
    sums = {row["kind"]: row["n"] for row in totals.where("gram IS NULL").collect()}
    often = totals.where((F.col("kind") == 2) & (F.col("n") >= max(2, share * sums.get(0, 0)))).select("gram").toArrow().column(0).to_numpy()
    buckets = max(partitions, -(-3 * sums.get(1, 0) // BUCKET_BYTES))
    packed = super_kmers(texts, window, gram, buckets, np.sort(often.astype("int64").view("uint64")))
    target = arrow_schema(spark, _FOUND)
    return placed(checkpointed(packed.groupBy("bucket").applyInArrow(lambda part: repeats_in_bucket(part, window, target), _FOUND), "found"))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("doc_id"), F.xxhash64(text).alias("text_hash"), utf8(F.col("text")).alias("text"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row; ``with_text`` adds the kept words, joined by spaces."""
    intervals = repeated_intervals(docs, window, gram)
    # A document has at most as many intervals as windows.
    lists = intervals.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    joined = _keyed(docs).join(lists, ["doc_id", "text_hash"], "left").select("doc_id", "text", F.col("spans.begin").alias("begins"), F.col("spans.end").alias("ends"))

    def work(ids, texts, begins, ends):
        out = {"doc_id": [None if i == _NO_ID else i for i in ids], "n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
        for text, begin, end in zip(texts, begins, ends, strict=True):
            words = text.split()
            gone = covered(len(words), begin, end) if begin else np.zeros(len(words), bool)
            kept = b" ".join(w for w, out_ in zip(words, gone.tolist(), strict=True) if not out_) if begin else b" ".join(words)
            out["n_words"].append(len(words))
            out["n_removed"].append(int(gone.sum()))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept.decode() if with_text else None)
        return out

    result = map_columns(joined, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string", work)
    return result if with_text else result.drop("kept")
