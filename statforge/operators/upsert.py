"""Keyed upserts as a reduction over changes.

A change is a row with a sequence (who wrote later). Current state is the winning change of every
key, found with a group limit before the shuffle, so replaying a change or hitting one key with a
third of all changes is harmless.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from statforge.operators.dedup import first_by_key, tie_break

LAST_WRITER = "last_writer"
LATEST_EVENT = "latest_event"

PARTIAL = "_partial"


def _key_columns(keys: Sequence[str], blank_null: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(k), F.lit("")) if k in blank_null else F.col(k) for k in keys]


def newest_in_batch(
    batch: DataFrame,
    keys: Sequence[str],
    newest: str | None,
    blank_null: Sequence[str] = (),
    arrival: Sequence[str] = (),
) -> DataFrame:
    """At most one change per key of a batch: the newest, then the last to arrive, then by value."""
    order = [F.col(c).desc_nulls_last() for c in (*([newest] if newest else []), *arrival)]
    return first_by_key(batch, _key_columns(keys, blank_null), order)


def resolve(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    policy: str = LAST_WRITER,
    event_time: str | None = None,
    blank_null: Sequence[str] = (),
) -> DataFrame:
    """State after applying all ``changes``.

    ``last_writer``: the highest ``sequence`` wins, even with an older event. ``latest_event``: the
    newest ``event_time`` wins, then the sequence. ``blank_null`` lists text key columns in which NULL
    and ``''`` are one key.
    """
    order = [F.col(c).desc_nulls_last() for c in sequence]
    if policy == LATEST_EVENT:
        if event_time is None:
            raise ValueError("policy 'latest_event' needs event_time")
        order.insert(0, F.col(event_time).desc_nulls_last())
    elif policy != LAST_WRITER:
        raise ValueError(f"unknown policy {policy!r}")
    return first_by_key(changes, _key_columns(keys, blank_null), order)


def resolve_partial(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    update_columns: Sequence[str],
    partial: str = PARTIAL,
    blank_null: Sequence[str] = (),
    keep_meta: bool = False,
) -> DataFrame:
    """State when changes flagged ``partial`` touch only ``update_columns`` of an existing key.

    A partial change to an unknown key inserts the whole row. So the update columns come from the
    last change, the others from the last full change or, if there is none, from the first change.
    One aggregation with map-side combine; a row brings its other columns once, as a full change or as a partial one. ``keep_meta`` keeps the sequence of the last change and
    flags the keys that had no full change, as ``merge`` needs them.
    """
    meta = {*keys, *sequence, partial}
    fixed = [c for c in changes.columns if c not in meta and c not in update_columns]
    order = F.struct(*sequence)
    stable = F.struct(*fixed, *keys)
    full = ~F.coalesce(F.col(partial), F.lit(False))
    key_columns = [c.alias(f"__k{i}") for i, c in enumerate(_key_columns(keys, blank_null))]
    reduced = changes.groupBy(*key_columns).agg(
        F.max_by(F.struct(*update_columns), order).alias("__new"),
        F.max_by(F.when(full, stable), F.when(full, order)).alias("__full"),
        F.min_by(F.when(~full, stable), F.when(~full, order)).alias("__first"),
        F.max(order).alias("__seq"),
    )
    base = F.coalesce("__full", "__first")
    picked = {c: base[c] for c in (*keys, *fixed)} | {c: F.col("__new")[c] for c in update_columns}
    if keep_meta:
        picked |= {c: F.col("__seq")[c] for c in sequence} | {partial: F.col("__full").isNull()}
    return reduced.select(*(picked[c].alias(c) for c in changes.columns if c in picked))


def resolve_sorted(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    update_columns: Sequence[str],
    partial: str = PARTIAL,
    blank_null: Sequence[str] = (),
    deal_by: Sequence[str] = (),
    tasks: int | None = None,
) -> DataFrame:
    """``resolve_partial`` where changes may share key and sequence: of these the first by value counts, as in ``newest_in_batch``.

    Every row crosses one shuffle and one sort, as it is. Nothing is reduced before the shuffle, so take the changes of ``crowded``
    parts out first. Rows are dealt to ``tasks`` tasks (by default the session's) by the keys in ``deal_by`` (by default all): keys
    that share these are alike, and alike rows side by side compress better.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    fixed = [c for c in changes.columns if c not in {*keys, *sequence, partial, *update_columns}]
    dealt = _key_columns(deal_by or keys, blank_null)
    rows = changes.repartition(tasks, *dealt) if tasks else changes.repartition(*dealt)
    rows = rows.select("*", *(c.alias(n) for c, n in zip(_key_columns(keys, blank_null), names)))
    newest_first = [*(F.col(c).desc_nulls_last() for c in sequence), *tie_break(changes, skip=[*sequence, partial])]
    by_key = Window.partitionBy(*names).orderBy(*newest_first)
    whole = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place, stable = F.struct(*sequence), F.struct(*fixed, *keys)
    full = ~F.coalesce(F.col(partial), F.lit(False))
    # The first row of each sequence stands for it.
    rows = rows.withColumn("__stands", ~F.lag(place).over(by_key).eqNullSafe(place))
    last_full = F.first(F.when(full, stable), ignorenulls=True).over(whole)
    first = F.last(F.when(F.col("__stands"), stable), ignorenulls=True).over(whole)
    rows = rows.select("*", F.row_number().over(by_key).alias("__rn"), F.coalesce(last_full, first).alias("__base")).where("__rn = 1")
    kept = {*keys, *fixed}
    picked = [c for c in changes.columns if c in kept or c in update_columns]
    return rows.select(*((F.col("__base")[c] if c in kept else F.col(f"`{c}`")).alias(c) for c in picked))


def crowded(rows: DataFrame, keys: Sequence[str], parts: int, limit: int, blank_null: Sequence[str] = ()) -> tuple[list[int], int]:
    """Which of ``parts`` hash parts of the keys (see ``bucket_of``) hold over ``limit`` rows and four times the mean, and the number of all rows.

    A key of that many rows is always in such a part. One count per part reaches the driver.
    """
    part = bucket_of(keys, parts, blank_null).alias("part")
    counts = {row["part"]: row["count"] for row in rows.groupBy(part).count().collect()}
    total = sum(counts.values())
    return sorted(k for k, n in counts.items() if n > max(limit, 4 * total // parts)), total


def merge(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    blank_null: Sequence[str] = (),
    update_columns: Sequence[str] | None = None,
    event_time: str | None = None,
    partial: str = PARTIAL,
) -> DataFrame:
    """State after ``changes`` on top of a ``base``; both have one row per key, and every change is later than the base.

    A matched row is replaced; with ``event_time`` only by a change that is not older (no time is the oldest). With ``update_columns``
    a change flagged ``partial`` alters only those columns of a matched row; a new key's change is taken whole either way. The wide
    base is read once, in a left join; which keys are new is found from its key columns alone. With few changes Spark broadcasts them
    (by their measured size) and the base is not shuffled; it is never grouped or sorted for the merge.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    own_keys = _key_columns(keys, blank_null)
    tagged = [c.alias(n) for c, n in zip(own_keys, names)]
    fresh = changes.select(*tagged, F.struct(*(F.col(f"`{c}`") for c in base.columns)).alias("__new"))
    new = F.col("__new")
    on = reduce(Column.__and__, (c.eqNullSafe(F.col(n)) for c, n in zip(own_keys, names)))
    hit = new.isNotNull()
    if event_time is not None:
        newer = F.col(f"`{event_time}`").isNull() | (new[event_time] >= F.col(f"`{event_time}`"))
        hit = hit & F.coalesce(newer, F.lit(False))

    def value(name: str) -> Column:
        always = update_columns is None or name in update_columns
        replaced = hit if always else hit & ~F.coalesce(new[partial], F.lit(False))
        return F.when(replaced, new[name]).otherwise(F.col(f"`{name}`")).alias(name)

    kept = base.join(fresh, on, "left").select(*(value(c) for c in base.columns))
    same = reduce(Column.__and__, (F.col(n).eqNullSafe(F.col(f"__b{n}")) for n in names))
    known = base.select(*tagged).join(fresh.select(*(F.col(n).alias(f"__b{n}") for n in names)), same, "left_semi")
    added = fresh.join(known.select(*(F.col(n).alias(f"__b{n}") for n in names)), same, "left_anti")
    return kept.unionByName(added.select("__new.*"))


def bucket_of(keys: Sequence[str], buckets: int, blank_null: Sequence[str] = ()) -> Column:
    """Hash bucket of a row's key; equal keys (blank and NULL included) share one."""
    return F.pmod(F.xxhash64(*_key_columns(keys, blank_null)), F.lit(buckets)).cast("int")


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    newest: str | None = None,
    policy: str = LAST_WRITER,
    blank_null: Sequence[str] = (),
) -> DataFrame:
    """``target`` after one batch: matched rows replaced (or partly updated), others inserted."""
    partial = update_columns is not None
    if policy not in (LAST_WRITER, LATEST_EVENT):
        raise ValueError(f"unknown policy {policy!r}")
    guarded = policy == LATEST_EVENT and not partial
    if guarded and newest is None:
        raise ValueError("policy 'latest_event' needs event_time")
    incoming = newest_in_batch(batch.select(*(F.col(f"`{c}`") for c in target.columns)), keys, newest, blank_null)
    base = target.withColumn(PARTIAL, F.lit(False))
    changes = incoming.withColumn(PARTIAL, F.lit(partial))
    return merge(base, changes, keys, blank_null, update_columns, newest if guarded else None).drop(PARTIAL)
