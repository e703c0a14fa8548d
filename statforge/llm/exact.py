"""Exact deduplication with a sharded cuckoo-filter index of live digests.

Every text has a digest, SHA-256 of its normalised form, computed by Spark. Digests are dealt out to shards by their leading bits. A
shard holds a cuckoo filter (two candidate buckets of four short fingerprints) beside its stored keys, bucketed by the same hash. A
filter miss proves a digest new. A filter hit is only a hint and is verified against the bucket's stored digests. A full
filter is rebuilt, twice as large, from the stored keys. Deleting a digest removes one fingerprint and its stored key, so documents
can be withdrawn later (``update_index``).

Each input task first runs its own rows through an index and hands on one row per digest, however many copies a group
has; no task ever sees a large group. The number of shards follows the number of rows.

Defined results: NULL text counts as empty, and all empty texts are one group. Of rows with one text, the largest doc_id stays; a NULL
id is smaller than any other. Rows that repeat both id and text are all reported as kept; ``drop_copies`` leaves one of them. Extra
columns are ignored by the report and kept by ``drop_copies``. Empty tables give empty results.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statforge.llm.shared import arrow_schema, checkpointed, lower_ascii

ROWS_PER_SHARD = 20_000
_SLOTS, _MOST_KICKS, _FLUSH = 4, 200, 100_000
_PARTIAL = "digest string, keep_id bigint, group_size bigint"


class CuckooIndex:
    """A cuckoo filter over hex digests, with their records (largest id, rows) in buckets beside it."""

    def __init__(self, buckets: int = 1024):
        self._reset(buckets)
        self.content: list[dict[str, list]] = [{} for _ in range(buckets)]
        self.size = 0

    def _reset(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.table: list[list[int]] = [[] for _ in range(buckets)]

    def _place(self, digest: str) -> tuple[int, int, int]:
        """Fingerprint (never 0) and both buckets. The leading bits chose the shard; these come from further on."""
        fingerprint = int(digest[16:20], 16) or 1
        first = int(digest[20:28], 16) & self.mask
        return fingerprint, first, self._other(first, fingerprint)

    def _other(self, bucket: int, fingerprint: int) -> int:
        return bucket ^ (fingerprint * 0x5BD1E995 >> 7) & self.mask

    def _hint(self, digest: str) -> bool:
        fingerprint, first, second = self._place(digest)
        return fingerprint in self.table[first] or fingerprint in self.table[second]

    def find(self, digest: str) -> list | None:
        """The record of a live digest. The filter's hits are verified against the stored keys."""
        if not self._hint(digest):
            return None
        return self.content[self._place(digest)[1]].get(digest)

    def add(self, digest: str, keep_id: int | None, rows: int) -> None:
        """Count ``rows`` more of a digest; its holder with the largest id is the live one."""
        record = self.find(digest)
        if record is not None:
            record[1] += rows
            if keep_id is not None and (record[0] is None or keep_id > record[0]):
                record[0] = keep_id
            return
        self.content[self._place(digest)[1]][digest] = [keep_id, rows]
        self.size += 1
        if not self._store(digest):
            self._grow()

    def remove(self, digest: str) -> bool:
        """Delete a live digest; whether there was one."""
        if self.find(digest) is None:
            return False
        fingerprint, first, second = self._place(digest)
        self.table[first if fingerprint in self.table[first] else second].remove(fingerprint)
        del self.content[first][digest]
        self.size -= 1
        return True

    def _store(self, digest: str) -> bool:
        fingerprint, bucket, second = self._place(digest)
        if len(self.table[bucket]) >= _SLOTS:
            bucket = second
        for kick in range(_MOST_KICKS):
            slots = self.table[bucket]
            if len(slots) < _SLOTS:
                slots.append(fingerprint)
                return True
            slots[kick % _SLOTS], fingerprint = fingerprint, slots[kick % _SLOTS]
            bucket = self._other(bucket, fingerprint)
        return False

    def _grow(self) -> None:
        """Rebuild filter and buckets at twice the size from the stored keys, until all fit."""
        records = list(self.items())
        while True:
            buckets = 2 * (self.mask + 1)
            self._reset(buckets)
            self.content = [{} for _ in range(buckets)]
            for digest, record in records:
                self.content[self._place(digest)[1]][digest] = record
            if all(self._store(digest) for digest, _ in records):
                return

    def items(self):
        for bucket in self.content:
            yield from bucket.items()


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of every row."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.sha2(lower_ascii(F.col("text")).cast("binary"), 256).alias("digest"))


def shard_count(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_SHARD))


def _sharded(df: DataFrame, shards: int) -> DataFrame:
    return df.withColumn("shard", (F.conv(F.substring("digest", 1, 12), 16, 10).cast("bigint") % shards).cast("int"))


def _by_task(rows: DataFrame) -> DataFrame:
    """One row per digest and task (and per 100,000 digests, to bound the memory)."""
    target = arrow_schema(rows.sparkSession, _PARTIAL)

    def run(batches):
        index = CuckooIndex()
        for batch in batches:
            for doc_id, digest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                index.add(digest, doc_id, 1)
                if index.size >= _FLUSH:
                    yield flushed(index)
                    index = CuckooIndex()
        yield flushed(index)

    def flushed(index: CuckooIndex) -> pa.RecordBatch:
        found = list(index.items())
        return pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], target.field(0).type), pa.array([r[0] for _, r in found], pa.int64()), pa.array([r[1] for _, r in found], pa.int64())], schema=target)

    return rows.mapInArrow(run, _PARTIAL)


def _records(index: CuckooIndex, shard: int) -> pd.DataFrame:
    found = list(index.items())
    return pd.DataFrame(
        {
            "shard": pd.Series([shard] * len(found), dtype="int32"),
            "digest": pd.Series([digest for digest, _ in found], dtype="object"),
            "keep_id": pd.Series([record[0] for _, record in found], dtype="object"),
            "group_size": pd.Series([record[1] for _, record in found], dtype="int64"),
        }
    )


def _fill(index: CuckooIndex, rows: pd.DataFrame) -> None:
    for digest, keep_id, size in zip(rows["digest"], rows["keep_id"], rows["group_size"], strict=True):
        index.add(digest, None if pd.isna(keep_id) else int(keep_id), int(size))


_INDEX = f"shard int, {_PARTIAL}"


def build_index(rows: DataFrame, shards: int) -> DataFrame:
    """The index of (doc_id, digest) rows: (shard, digest, keep_id, group_size), one row per live digest."""

    def merge(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        index = CuckooIndex()
        _fill(index, part)
        return _records(index, int(key[0]))

    return _sharded(_by_task(rows), shards).groupBy("shard").applyInPandas(merge, _INDEX)


def update_index(index: DataFrame, shards: int, added: DataFrame, removed: DataFrame) -> DataFrame:
    """``index`` after the digests of ``removed`` are withdrawn and the (doc_id, digest) rows of ``added`` are counted.

    Each shard is changed on its own: its filter is filled from its stored keys, then takes the deletions and insertions.
    """
    changes = _by_task(added).withColumn("gone", F.lit(False))
    gone = removed.select("digest").distinct().select("digest", F.lit(None).cast("bigint").alias("keep_id"), F.lit(0).cast("bigint").alias("group_size"), F.lit(True).alias("gone"))

    def change(key: tuple, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        live = CuckooIndex()
        _fill(live, old)
        gone_here = new["gone"].to_numpy(dtype=bool)
        for digest in new.loc[gone_here, "digest"]:
            live.remove(digest)
        _fill(live, new.loc[~gone_here])
        return _records(live, int(key[0]))

    return index.groupBy("shard").cogroup(_sharded(changes.unionByName(gone), shards).groupBy("shard")).applyInPandas(change, _INDEX)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``."""
    rows = checkpointed(digests(docs), "digests")
    index = build_index(rows, shard_count(rows.count())).drop("shard")
    return rows.join(index, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256")
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns unchanged."""
    rows = checkpointed(digests(docs), "digests")
    keep = build_index(rows, shard_count(rows.count())).select(F.col("digest").alias("__digest"), F.col("keep_id").alias("__keep"))
    marked = docs.withColumn("__own", F.sha2(lower_ascii(F.col("text")).cast("binary"), 256))
    # Id and digest are the key, so the copies of one text are dealt out apart.
    found = marked.join(keep, (F.col("__own") == F.col("__digest")) & F.col("doc_id").eqNullSafe(F.col("__keep")))
    orderable = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    repeated = Window.partitionBy("__digest", "__keep").orderBy(*orderable)
    return found.withColumn("__n", F.row_number().over(repeated)).where("__n = 1").select(*[f"`{c}`" for c in docs.columns])


SQL = """
    WITH normal AS (
        SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
        FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, text_sha256
    FROM normal WINDOW g AS (PARTITION BY text_sha256)"""
