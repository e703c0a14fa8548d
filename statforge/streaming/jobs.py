"""Structured Streaming jobs: text messages in, keyed upserts out."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statforge.functions import messages as M
from statforge.operators import upsert as U
from statforge.operators.upsert import newest_in_batch
from statforge.plans.views import STANDING_KEY
from statforge.streaming.store import UpsertTable


@dataclass(frozen=True)
class Topic:
    """How the messages of one topic become rows of one table."""

    name: str
    schema: str
    flatten: Callable[..., DataFrame]
    keys: tuple[str, ...]
    newest: str | None
    trigger: str
    blank_null: tuple[str, ...] = ()
    # A field that every readable message has.
    probe: str = "id"

    def rows(self, messages: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        """Parsed and flattened rows, for a batch or a stream."""
        return self.flatten(M.parse(messages, self.schema, tuple(carry)), carry=tuple(carry))

    def table(self, spark: SparkSession, root: str, policy: str = U.LAST_WRITER, **kw) -> UpsertTable:
        return UpsertTable(spark, root, self.keys, self.newest, policy, self.blank_null, **kw)


# Keys, newest-first column and trigger interval per topic.
MATCHES = Topic("matches", M.MATCH, M.flatten_match, ("match_id",), "last_updated", "15 seconds")
COMPETITIONS = Topic(
    "competitions", M.COMPETITION, M.flatten_competition, ("competition_id",), "last_updated", "60 seconds"
)
STANDINGS = Topic(
    "standings", M.STANDINGS, M.flatten_standings, STANDING_KEY, "processed_at", "60 seconds", ("group_name",), "competition.id"
)
# Columns of the message source that break ties inside a batch: the later message wins.
ARRIVAL = ("timestamp", "partition", "offset")
# What loading standings from files changes in a row that exists.
FILE_UPDATES = [
    "position", "team_name", "team_short_name", "team_tla", "team_crest_url", "played_games", "won", "draw",
    "lost", "points", "goals_for", "goals_against", "goal_difference", "form", "current_matchday",
    "processed_at",
]


def upsert_batches(
    topic: Topic, table: UpsertTable, run: str, compact_every: int = 50
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: flatten, keep the newest change per key, record.

    Errors are not caught: a failed batch fails the query and is run again after a restart. The parsed messages are not
    kept: unreadable ones are counted while the changes are written, and only if there are any, the batch is read
    again to store them beside the log. An empty batch writes an empty change set.
    """

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        carry = [c for c in ARRIVAL if c in batch.columns]
        parsed = M.parse(batch, topic.schema, tuple(carry))
        broken = F.count_if(F.col(f"data.{topic.probe}").isNull()).alias("broken")
        seen = None if table.covers(run, batch_id) else Observation()
        counted = parsed if seen is None else parsed.observe(seen, broken)
        table.apply(topic.flatten(counted, carry=tuple(carry)), run, batch_id, arrival=carry)
        # A batch that the base holds is not written again, and a write of no rows may not count: then nothing is known.
        if seen is None or seen.get.get("broken") != 0:
            table.quarantine(M.unreadable(parsed, topic.probe), run, batch_id)
        if compact_every and batch_id and batch_id % compact_every == 0:
            table.compact()

    return run_batch


def start_upserts(
    messages: DataFrame,
    topic: Topic,
    table: UpsertTable,
    checkpoint: str,
    available_now: bool = False,
    compact_every: int = 50,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start one upsert query. The checkpoint makes a restart continue where the last run ended."""
    run = table.run_for(checkpoint)
    writer = (
        messages.writeStream.foreachBatch(upsert_batches(topic, table, run, compact_every))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .queryName(query_name or f"upsert_{topic.name}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=topic.trigger)
    return writer.start()


def run_until_done(queries: Sequence[StreamingQuery]) -> None:
    """Wait for bounded (available-now) queries; the first error is raised, whichever query it hits."""
    for query in await_first_failure(queries):
        query.awaitTermination()


def await_first_failure(queries: Sequence[StreamingQuery], poll_seconds: float = 1.0) -> list[StreamingQuery]:
    """Wait until all queries have ended or one has failed; the failed one's error is raised and the others are stopped.

    Works for unbounded queries, too: none is waited for while another has already failed.
    """
    running = list(queries)
    while running:
        for query in list(running):
            try:
                ended = query.awaitTermination(poll_seconds / len(running))
            except Exception:
                for other in queries:
                    other.stop()
                raise
            if ended:
                running.remove(query)
    return list(queries)


# Keys by which rows of standings are dealt to tasks, parts of the key space in which rows are counted, rows of a part that may hold a hot key, rows sorted by one task.
DEAL_BY = ("competition_id", "season_id", "team_id")
KEY_PARTS = 4096
CROWDED_ROWS = 100_000
ROWS_PER_TASK = 1_000_000


def load_standings_files(state: DataFrame | None, files: DataFrame, path_column: str, crowded_rows: int = CROWDED_ROWS) -> DataFrame:
    """State after loading standings files in name order onto ``state``.

    A row that exists keeps its competition, season-date and area columns. All files are applied in
    one reduction instead of one pass per file. A count by key hash finds the parts of the key space that may hold a hot key; their
    rows are reduced before every shuffle, all others cross a single one. So ``files`` are read twice: store them if that is dear.
    """
    blank, seq = ("group_name",), "_seq"
    hot, total = U.crowded(files, DEAL_BY, KEY_PARTS, crowded_rows)
    often = U.bucket_of(DEAL_BY, KEY_PARTS).isin(hot)
    old = None if state is None else state.withColumns({seq: F.lit(""), U.PARTIAL: F.lit(False)})

    def changes(rows: DataFrame, chosen: Column) -> DataFrame:
        new = rows.where(chosen).withColumnRenamed(path_column, seq).withColumn(U.PARTIAL, F.lit(True))
        return new if old is None else new.unionByName(old.where(chosen))

    tasks = total // ROWS_PER_TASK
    tasks = tasks if tasks > int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None
    loaded = U.resolve_sorted(changes(files, ~often), STANDING_KEY, [seq], FILE_UPDATES, blank_null=blank, deal_by=DEAL_BY, tasks=tasks)
    if hot:
        reduced = newest_in_batch(files.where(often), [*STANDING_KEY, path_column], None, blank)
        loaded = loaded.unionByName(U.resolve_partial(changes(reduced, often), STANDING_KEY, [seq], FILE_UPDATES, blank_null=blank))
    return loaded if state is None else loaded.select(*(c for c in state.columns if c in loaded.columns))
