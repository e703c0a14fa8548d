"""Bulk-synchronous best-fit packing of token sequences.

Documents are tokenised and cut into pieces. Pieces are range-sorted by length, with a hash as tie-break so that one frequent
length spreads over many tasks, and written: a row's rank among the pieces of its length follows from its place in its
partition and one count per (partition, length).

Matching then goes in supersteps, from the longest pieces to the shortest. Sorted pieces and sorted gaps are handled as runs: pieces of
one length are a run of ranks, sequences with one gap are runs of sequence numbers. In a superstep all pieces of a length sweep over their
successor gaps (the smallest first that are large enough). Where several want one gap, their ranks decide: the i-th piece takes
the run's i-th sequence. What finds no gap opens new sequences. The gaps taken are updated, and the next superstep begins. Lengths are
whole numbers up to the capacity, so the runs are a table whose size does not depend on the number of documents (2048 lengths, some
ten thousand runs); only these counts and runs reach the driver. The pieces themselves are matched to
runs by a join on length and rank, and never leave the executors. The result is that of best-fit decreasing.

Defined results: NULL or empty text is one piece holding only the end id. A document longer than the capacity is cut into full pieces, after a first
piece of what is left over. Repeated rows are packed each. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statforge.llm.shared import checkpointed, map_columns

CAPACITY = 2048
#: The byte-level BPE vocabulary as ranks; gives the ids of the same vocabulary's tokenizer file.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
# Fixed value: the vocabulary's only special token.
SPECIAL = {"<|endoftext|>": 50256}
_LOCAL_BITS = 33  # of monotonically_increasing_id()


@functools.lru_cache(1)
def encoder(ranks: str) -> tiktoken.Encoding:
    """The tokenizer, loaded once a worker."""
    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens=SPECIAL)


def token_ids(text: str | None, ranks: str = RANKS, end_id: int = 0) -> np.ndarray:
    """The document's ids, closed by ``end_id``."""
    ids = encoder(ranks).encode_to_numpy(text or "", allowed_special="all")
    return np.append(ids, end_id).astype("<u4")


def cuts(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a document; all but the first are full."""
    first = length % capacity or capacity
    edges = [0, *range(first, length + 1, capacity)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def pieces(docs: DataFrame, capacity: int = CAPACITY, ranks: str = RANKS, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece; ``with_ids`` adds its ids as little-endian bytes."""

    def work(doc_ids, texts):
        out = defaultdict(list)
        for doc_id, text in zip(doc_ids, texts, strict=True):
            ids = token_ids(text, ranks)
            for number, (start, end) in enumerate(cuts(len(ids), capacity)):
                part = ids[start:end].tobytes()
                for name, value in (("doc_id", doc_id), ("piece", number), ("start", start), ("length", end - start), ("ids_crc32", zlib.crc32(part))):
                    out[name].append(value)
                if with_ids:
                    out["ids"].append(part)
        return {name: out[name] for name in ("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []))}

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return map_columns(docs.select(F.col("doc_id").cast("bigint"), "text"), schema, work)


class Gaps:
    """Open sequences as runs (first number, how many) by gap, with successor search."""

    def __init__(self, capacity: int):
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        self.capacity, self.opened = capacity, 0

    def successor(self, size: int) -> int | None:
        return next((gap for gap in range(size, self.capacity + 1) if self.runs[gap]), None)

    def open(self, number: int) -> None:
        self.runs[self.capacity].append((self.opened, number))
        self.opened += number


def sweep(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """All supersteps over the counts of pieces by length: runs (length, first rank, pieces, first sequence, offset)."""
    gaps, matched = Gaps(capacity), []
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            gap = gaps.successor(length)
            if gap is None:
                gaps.open(-(-left // (capacity // length)))
                continue
            first, number = gaps.runs[gap].pop()
            taken = min(left, number)
            matched.append((length, rank, taken, first, capacity - gap))
            if gap > length:
                gaps.runs[gap - length].append((first, taken))
            if taken < number:
                gaps.runs[gap].append((first + taken, number - taken))
            left, rank = left - taken, rank + taken
    return matched


def best_fit(sized: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sized``, rows with a column ``length`` from 1 to ``capacity``, with sequence_id and offset."""
    spark, columns = sized.sparkSession, sized.columns
    spread = F.xxhash64(*[c for c, kind in sized.dtypes if kind in ("bigint", "int")])
    # The sort is written: ranks must be those of one and the same order in every later task.
    ranged = checkpointed(
        sized.withColumn("__spread", spread).repartitionByRange("length", "__spread").sortWithinPartitions("length", "__spread").withColumn("__row", F.monotonically_increasing_id()),
        "ranged",
    )
    task = F.shiftright("__row", _LOCAL_BITS)
    # At most one row per length, and one more per task.
    counted = sorted(ranged.groupBy(task.alias("task"), "length").count().collect())
    shifts, totals, inside = [], defaultdict(int), defaultdict(int)
    for number, length, count in counted:
        shifts.append((number, length, totals[length] - inside[number]))
        totals[length] += count
        inside[number] += count
    runs = sweep(dict(totals), capacity)
    shift_table = spark.createDataFrame(shifts, "__task bigint, __slength bigint, __shift bigint")
    run_table = spark.createDataFrame(runs, "__rlength bigint, __first bigint, __number bigint, __sequence bigint, __offset bigint")
    ranked = ranged.join(F.broadcast(shift_table), (task == F.col("__task")) & (F.col("length") == F.col("__slength"))).withColumn(
        "__rank", F.col("__row").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)) + F.col("__shift")
    )
    fits = (F.col("length") == F.col("__rlength")) & (F.col("__rank") >= F.col("__first")) & (F.col("__rank") < F.col("__first") + F.col("__number"))
    return ranked.join(F.broadcast(run_table), fits).select(
        *columns, (F.col("__sequence") + F.col("__rank") - F.col("__first")).alias("sequence_id"), F.col("__offset").alias("offset")
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, ranks: str = RANKS, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every document."""
    return best_fit(checkpointed(pieces(docs, capacity, ranks, with_ids), "pieces"), capacity)
