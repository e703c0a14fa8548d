"""A keyed table kept as a change log plus snapshots, for upserts without a table format.

Layout below the table's root::

    log/seq=<n>/writer=<digest>/batch=<id>/     the changes of one micro-batch, one per key
    unreadable/writer=<digest>/batch=<id>/      messages of a micro-batch that could not be read
    cover/seq=<n>/                              how far each writer's batches are in the base of that number
    base/seq=<n>/_bucket=<k>/                   state after change n, by hash bucket of the key

Every committed batch has a number of its own in the whole table, given when it is first committed; a replay of the same writer's batch
finds that number and keeps it, or is passed over once a base holds it. So batches of several writers are ordered by when they were
committed, not by writer. ``compact`` writes only the buckets that changed; the others stay where an earlier one put them. A batch or base counts
only once Spark has committed it (``_SUCCESS``), so a lost writer leaves the old state valid. Nothing that is being read is
overwritten. Writers take turns: there are no concurrent commits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statforge.operators import upsert as U
from statforge.sinks.files import child_dirs, drop_dir, write_parquet

_SEQ, _BUCKET = "_seq", "_bucket"


class Entry(NamedTuple):
    """One committed batch of the log."""

    seq: int
    writer: str
    batch: int
    path: str


class UpsertTable:
    """Current state of a table that receives keyed batches.

    ``newest`` orders changes inside a batch (and, with ``latest_event``, across batches);
    ``blank_null`` lists text key columns where NULL and ``''`` are one key; ``update_columns`` are
    the columns that a partial batch may change in an existing row. ``buckets`` is the unit of
    compaction and must not change during a table's life; a bucket is written by as many tasks as its size asks for.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: Sequence[str],
        newest: str | None = None,
        policy: str = U.LAST_WRITER,
        blank_null: Sequence[str] = (),
        update_columns: Sequence[str] | None = None,
        buckets: int = 64,
    ):
        if update_columns is not None and policy != U.LAST_WRITER:
            raise ValueError("partial updates are applied in writing order; use policy 'last_writer'")
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self.newest, self.policy, self.blank_null = newest, policy, tuple(blank_null)
        self.buckets = buckets
        self.update_columns = None if update_columns is None else list(update_columns)

    # ---- writers -----------------------------------------------------------------------------

    @staticmethod
    def run_for(writer: str) -> str:
        """Name of ``writer`` in paths (for a stream: its checkpoint location, as batch ids start over with a new one)."""
        return hashlib.sha256(writer.encode()).hexdigest()

    # ---- writing -----------------------------------------------------------------------------

    def apply(self, batch: DataFrame, run: str, batch_id: int, partial: bool = False, arrival: Sequence[str] = ()) -> int:
        """Record one batch, newest change per key; returns the number of changes.

        ``arrival`` names columns that order equally new changes (later wins) and are not stored.
        """
        if partial and self.update_columns is None:
            raise ValueError("a partial batch needs a table with update_columns")
        if self.covers(run, batch_id):
            return 0  # a replay of what the base holds
        changes = U.newest_in_batch(batch, self.keys, self.newest, self.blank_null, arrival).drop(*arrival)
        number = self._number(run, int(batch_id))
        stamped = changes.withColumns({_SEQ: F.lit(number).cast("bigint"), U.PARTIAL: F.lit(partial)})
        return write_parquet(stamped, f"{self.root}/log/seq={number:012d}/writer={run}/batch={int(batch_id):012d}")

    def covers(self, run: str, batch_id: int) -> bool:
        """Whether the base holds this batch, so that ``apply`` passes a replay over."""
        return batch_id <= self._covered().get(run, -1)

    def quarantine(self, messages: DataFrame, run: str, batch_id: int) -> None:
        """Store the unreadable messages of a batch, if any; a replay replaces them."""
        if not messages.isEmpty():
            write_parquet(messages, f"{self.root}/unreadable/writer={run}/batch={int(batch_id):012d}")

    def unreadable(self) -> DataFrame | None:
        """All messages in quarantine with their writer and batch, None if there never were any."""
        path = f"{self.root}/unreadable"
        return self.spark.read.parquet(path) if child_dirs(self.spark, path, committed=False) else None

    def _number(self, run: str, batch_id: int) -> int:
        """The batch's number if it is committed, else the next one; numbers of lost writes are not used again."""
        for entry in self._log_dirs():
            if (entry.writer, entry.batch) == (run, batch_id):
                return entry.seq
        seen = [int(d[4:]) for part in ("log", "base") for d in child_dirs(self.spark, f"{self.root}/{part}", committed=False)]
        return 1 + max(seen, default=0)

    def compact(self) -> int:
        """Fold the log into new versions of the buckets it touches; returns the rows written.

        What readers of the previous state may still use is kept until the next call.
        """
        log = self._log()
        if not log:
            return 0
        bucket = U.bucket_of(self.keys, self.buckets, self.blank_null)
        changes = self._read(log)
        touched = {row[0] for row in changes.select(bucket).distinct().collect()}  # at most ``buckets``
        if not touched:
            return 0
        before, reached = self._base(), self._reached()
        old = [path for k, path in before.items() if k in touched]
        state = self._merged(old, log).withColumn(_BUCKET, bucket)
        number = log[-1].seq
        covered = self._covered()
        for entry in log:
            covered[entry.writer] = max(covered.get(entry.writer, -1), entry.batch)
        cover = self.spark.createDataFrame(sorted(covered.items()), "writer string, batch bigint")
        write_parquet(cover, f"{self.root}/cover/seq={number:012d}")
        # Large partitions are split further by size, so a bucket may be several files.
        rows = write_parquet(state.hint("rebalance", _BUCKET), f"{self.root}/base/seq={number:012d}", [_BUCKET])
        self._tidy(before, reached)
        return rows

    def _tidy(self, before: dict[int, str], reached: int) -> None:
        """Drop base versions and log entries that neither the new nor the previous state reads."""
        live = {path.rsplit("/", 1)[0] for path in (*before.values(), *self._base().values())}
        for number in self._numbers("base"):
            path = f"{self.root}/base/seq={number:012d}"
            if path not in live:
                drop_dir(self.spark, path)
        for number in self._numbers("cover")[:-2]:
            drop_dir(self.spark, f"{self.root}/cover/seq={number:012d}")
        for entry in self._log_dirs():
            if entry.seq <= reached:
                drop_dir(self.spark, f"{self.root}/log/seq={entry.seq:012d}")

    # ---- reading -----------------------------------------------------------------------------

    def current(self) -> DataFrame:
        """Current rows, without bookkeeping columns."""
        log, base = self._log(), list(self._base().values())
        if not log and not base:
            raise FileNotFoundError(f"no committed batch below {self.root}")
        state = self._merged(base, log) if log else self.spark.read.parquet(*base)
        return state.drop(_SEQ, U.PARTIAL)

    def _read(self, log: list[Entry]) -> DataFrame:
        return self.spark.read.parquet(*(entry.path for entry in log))

    def _merged(self, base: list[str], log: list[Entry]) -> DataFrame:
        """State of the buckets in ``base`` after the changes in ``log``, which are reduced to one a key before they meet the base.

        A single batch was reduced to one a key when it was recorded: its rows are not shuffled and sorted a second time.
        """
        changes = self._read(log)
        reduced = changes if len(log) == 1 else self._resolve(changes)
        if not base:
            return reduced
        guard = self.newest if self.policy == U.LATEST_EVENT else None
        updates = None if self.update_columns is None else [*self.update_columns, _SEQ]
        return U.merge(self.spark.read.parquet(*base), reduced, self.keys, self.blank_null, updates, guard)

    def _resolve(self, changes: DataFrame) -> DataFrame:
        sequence = [_SEQ]
        if self.update_columns is None:
            return U.resolve(changes, self.keys, sequence, self.policy, self.newest, self.blank_null)
        return U.resolve_partial(
            changes, self.keys, sequence, self.update_columns, blank_null=self.blank_null, keep_meta=True
        )

    def _base(self) -> dict[int, str]:
        """Newest committed directory of every bucket."""
        newest: dict[int, str] = {}
        for number in self._numbers("base"):
            path = f"{self.root}/base/seq={number:012d}"
            for name in child_dirs(self.spark, path, committed=False):
                newest[int(name.split("=")[1])] = f"{path}/{name}"
        return newest

    def _numbers(self, part: str) -> list[int]:
        """Numbers of the committed directories of ``base`` or ``cover``, ascending."""
        return sorted(int(name[4:]) for name in child_dirs(self.spark, f"{self.root}/{part}"))

    def _reached(self) -> int:
        """Number of the last change that the base holds."""
        return max(self._numbers("base"), default=0)

    def _covered(self) -> dict[str, int]:
        """The last batch of each writer that the base holds; one row per writer."""
        reached = self._reached()
        if not reached:
            return {}
        return {row["writer"]: row["batch"] for row in self.spark.read.parquet(f"{self.root}/cover/seq={reached:012d}").collect()}

    def _log(self) -> list[Entry]:
        """Committed batches that are newer than the newest base version."""
        reached = self._reached()
        return [entry for entry in self._log_dirs() if entry.seq > reached]

    def _log_dirs(self) -> list[Entry]:
        """All committed batches of the log, oldest first."""
        found, top = [], f"{self.root}/log"
        for number in child_dirs(self.spark, top, committed=False):
            for writer in child_dirs(self.spark, f"{top}/{number}", committed=False):
                for batch in child_dirs(self.spark, f"{top}/{number}/{writer}"):
                    found.append(Entry(int(number[4:]), writer[7:], int(batch[6:]), f"{top}/{number}/{writer}/{batch}"))
        return sorted(found)
