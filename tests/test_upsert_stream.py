import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from statforge.functions import messages as M
from statforge.operators import upsert as U
from statforge.plans.views import STANDING_KEY
from statforge.streaming.jobs import COMPETITIONS, FILE_UPDATES, MATCHES, STANDINGS, load_standings_files, run_until_done, start_upserts, upsert_batches
from statforge.streaming.store import UpsertTable

CHANGES = "k int, v string, t int, _run int, _batch bigint"


def test_last_writer_and_latest_event(spark):
    data = [(1, "new", 9, 1, 0), (1, "late", 3, 1, 1), (2, "a", None, 1, 0), (2, "b", None, 1, 1)]
    df = spark.createDataFrame(data, CHANGES)
    seq = ["_run", "_batch"]
    assert rows(U.resolve(df, ["k"], seq).select("k", "v"), "k") == [(1, "late"), (2, "b")]
    guarded = U.resolve(df, ["k"], seq, U.LATEST_EVENT, "t")
    assert rows(guarded.select("k", "v"), "k") == [(1, "new"), (2, "b")]
    with pytest.raises(ValueError):
        U.resolve(df, ["k"], seq, "other")
    with pytest.raises(ValueError):
        U.resolve(df, ["k"], seq, U.LATEST_EVENT)


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, t int")
    batch = spark.createDataFrame([(2, "x", 5), (2, "y", 6), (3, "n", 1)], "k int, v string, t int")
    once = U.upsert(target, batch, ["k"], newest="t")
    assert rows(once, "k") == [(1, "a", 1), (2, "y", 6), (3, "n", 1)]
    assert rows(U.upsert(once, batch, ["k"], newest="t"), "k") == rows(once, "k")


def test_null_and_blank_are_one_key(spark):
    target = spark.createDataFrame([(1, None, 1), (2, "", 1)], "k int, g string, v int")
    batch = spark.createDataFrame([(1, "", 2), (2, None, 2)], "k int, g string, v int")
    assert rows(U.upsert(target, batch, ["k", "g"], blank_null=["g"]), "k") == [(1, "", 2), (2, None, 2)]
    assert U.upsert(target, batch, ["k", "g"]).count() == 4


def test_partial_updates(spark):
    target = spark.createDataFrame([(1, "keep", 1), (2, None, 1)], "k int, name string, v int")
    batch = spark.createDataFrame([(1, "ignored", 2), (3, "inserted", 3), (2, "ignored", None)], "k int, name string, v int")
    out = U.upsert(target, batch, ["k"], update_columns=["v"])
    assert rows(out, "k") == [(1, "keep", 2), (2, None, None), (3, "inserted", 3)]


def test_partial_against_a_step_by_step_merge(spark):
    """Random full and partial changes against a plain dictionary."""
    rng = random.Random(4)
    changes, state = [], {}
    for seq in range(300):
        key, partial = rng.randrange(20), rng.random() < 0.6
        record = {"a": rng.choice([None, seq]), "b": rng.choice([None, seq])}
        changes.append((key, record["a"], record["b"], seq, partial))
        old = state.get(key)
        state[key] = record if old is None or not partial else {"a": old["a"], "b": record["b"]}
    df = spark.createDataFrame(changes, "k int, a int, b int, seq int, _partial boolean").repartition(5)
    got = rows(U.resolve_partial(df, ["k"], ["seq"], ["b"]), "k")
    assert got == sorted((k, r["a"], r["b"]) for k, r in state.items())


def table_at(spark, folder, **kw):
    return UpsertTable(spark, f"{folder}/table", ["k"], kw.pop("newest", "t"), **kw)


def changes(spark, *data):
    return spark.createDataFrame(list(data), "k int, v string, t int")


def test_store_replay_runs_and_compaction(spark, folder):
    table = table_at(spark, folder)
    with pytest.raises(FileNotFoundError):
        table.current()
    first = table.run_for("checkpoint-a")
    assert table.apply(changes(spark, (1, "a", 5), (1, "b", 6), (2, "c", 1)), first, 0) == 2
    assert table.apply(changes(spark, (1, "late", 2)), first, 1) == 1
    expected = [(1, "late", 2), (2, "c", 1)]
    assert rows(table.current(), "k") == expected
    table.apply(changes(spark, (1, "late", 2)), first, 1)  # replay
    assert rows(table.current(), "k") == expected
    assert table.run_for("checkpoint-a") == first
    # A new checkpoint starts again at batch 0, which must still be the later change.
    second = table.run_for("checkpoint-b")
    assert second != first
    table.apply(changes(spark, (2, "d", 0)), second, 0)
    expected = [(1, "late", 2), (2, "d", 0)]
    assert rows(table.current(), "k") == expected
    reader = table.current()
    assert table.compact() == 2 and table.compact() == 0
    assert rows(table.current(), "k") == expected == rows(reader, "k")
    table.apply(changes(spark, (3, "e", 1)), second, 1)
    assert rows(table.current(), "k") == [*expected, (3, "e", 1)]
    table.apply(changes(spark, (2, "replayed", 9)), second, 0)  # covered by the base
    assert rows(table.current(), "k") == [*expected, (3, "e", 1)]
    bases = set(table._base().values())
    assert table.compact() == 1  # only the bucket of key 3 is written
    assert rows(table.current(), "k") == [*expected, (3, "e", 1)]
    assert len(set(table._base().values()) - bases) == 1
    assert table.run_for("checkpoint-b") == second


@pytest.mark.parametrize("updates", [None, ["v"]])
def test_a_single_batch_is_not_reduced_a_second_time(spark, folder, updates):
    """A batch holds one change a key when it is in the log; shuffling and sorting it again only took disk."""
    table = UpsertTable(spark, f"{folder}/t", ["k", "g"], "t", blank_null=["g"], update_columns=updates)
    run, schema = table.run_for("w"), "k int, g string, t int, v string"
    moved = lambda: "Exchange" in table.current()._jdf.queryExecution().executedPlan().toString()
    first = [(1, None, 1, "a"), (1, "", 2, "b"), (1, "", 2, "a"), (None, "x", 1, "c"), (None, "x", 1, "c"), (2, "x", None, "d")]
    assert table.apply(spark.createDataFrame(first, schema), run, 0, partial=updates is not None) == 3
    assert not moved() and sorted(rows(table.current()), key=repr) == [(1, "", 2, "a"), (2, "x", None, "d"), (None, "x", 1, "c")]
    table.apply(spark.createDataFrame([(1, None, 0, "e"), (3, "", 1, "f")], schema), run, 1)
    now = [(1, None, 0, "e"), (2, "x", None, "d"), (3, "", 1, "f"), (None, "x", 1, "c")]
    assert moved() and sorted(rows(table.current()), key=repr) == now
    table.compact()
    # One batch on top of a base.
    table.apply(spark.createDataFrame([(None, "x", 5, "g"), (None, "x", 4, "h"), (4, None, 1, "i")], schema), run, 2)
    now = [*now[:3], (4, None, 1, "i"), (None, "x", 5, "g")]
    assert sorted(rows(table.current()), key=repr) == now
    table.compact()
    assert sorted(rows(table.current()), key=repr) == now


@pytest.mark.parametrize("compacted", [False, True])
def test_alternating_writers_lose_nothing(spark, folder, compacted):
    """A0, B0, A1: A wrote last, whether or not the log is folded in between; replays change nothing."""
    table = table_at(spark, folder)
    a, b = table.run_for("stream-a"), table.run_for("loader-b")
    table.apply(changes(spark, (1, "a0", 1)), a, 0)
    table.apply(changes(spark, (1, "b0", 2)), b, 0)
    if compacted:
        table.compact()
    table.apply(changes(spark, (1, "a1", 3), (2, "new", 3)), a, 1)
    expected = [(1, "a1", 3), (2, "new", 3)]
    assert rows(table.current(), "k") == expected
    table.apply(changes(spark, (1, "a0", 1)), a, 0)
    table.apply(changes(spark, (1, "b0", 2)), b, 0)
    assert rows(table.current(), "k") == expected
    table.compact()
    table.apply(changes(spark, (1, "a1", 3), (2, "new", 3)), a, 1)
    assert rows(table.current(), "k") == expected
    table.apply(changes(spark, (1, "b1", 4)), b, 1)
    assert rows(table.current(), "k") == [(1, "b1", 4), (2, "new", 3)]


def test_store_against_a_step_by_step_merge(spark, folder):
    """Random batches with compactions in between, against a plain dictionary."""
    rng = random.Random(5)
    table, state = UpsertTable(spark, f"{folder}/t", ["k", "g"], "t", blank_null=["g"], buckets=4), {}
    run = table.run_for("w")
    for batch_id in range(8):
        batch = [(rng.randrange(30), rng.choice([None, "", "a"]), rng.randrange(100), batch_id * 100 + i) for i in range(20)]
        table.apply(spark.createDataFrame(batch, "k int, g string, t int, v int"), run, batch_id)
        newest = {}
        for k, g, t, v in batch:
            old = newest.get((k, g or ""))
            if old is None or t > old[2]:
                newest[k, g or ""] = (k, g, t, v)
        ties = {}
        for row in batch:
            ties.setdefault((row[0], row[1] or "", row[2]), []).append(row)
        for key, row in newest.items():
            state[key] = row if len(ties[(*key, row[2])]) == 1 else None
        if batch_id in (2, 3, 6):
            table.compact()
        got = {(r.k, r.g or ""): tuple(r) for r in table.current().collect()}
        assert set(got) == set(state)
        assert all(got[key] == row for key, row in state.items() if row is not None)


def test_uncommitted_batches_are_invisible(spark, folder):
    table = table_at(spark, folder)
    run = table.run_for("w")
    table.apply(changes(spark, (1, "a", 1)), run, 0)
    table.apply(changes(spark, (1, "b", 2)), run, 1)
    os.remove(f"{folder}/table/log/seq={2:012d}/writer={run}/batch={1:012d}/_SUCCESS")
    assert rows(table.current()) == [(1, "a", 1)]
    table.apply(changes(spark, (1, "c", 3)), table.run_for("other"), 0)
    table.apply(changes(spark, (1, "b", 2)), run, 1)  # first committed now, so it comes last
    assert rows(table.current()) == [(1, "b", 2)]


def test_store_with_partial_batches(spark, folder):
    table = table_at(spark, folder, newest=None, update_columns=["v"])
    run = table.run_for("w")
    table.apply(changes(spark, (1, "a", 1)), run, 0)
    table.apply(changes(spark, (1, "b", 2), (2, "c", 3)), run, 1, partial=True)
    expected = [(1, "b", 1), (2, "c", 3)]
    assert rows(table.current(), "k") == expected
    table.compact()
    table.apply(changes(spark, (2, "d", 9)), run, 2, partial=True)
    assert rows(table.current(), "k") == [(1, "b", 1), (2, "d", 3)]
    with pytest.raises(ValueError):
        table_at(spark, folder).apply(changes(spark, (1, "a", 1)), run, 3, partial=True)
    with pytest.raises(ValueError):
        table_at(spark, folder, update_columns=["v"], policy=U.LATEST_EVENT)


def match(ident, updated, status="IN_PLAY"):
    return json.dumps({"id": ident, "utcDate": "2024-01-01T20:00:00Z", "status": status, "lastUpdated": f"2024-01-01T00:00:{updated:02d}Z"})


KAFKA = "value string, topic string, partition int, offset bigint, timestamp timestamp"


def drop_file(spark, folder, name, messages):
    data = [(m, "t", 0, i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)) for i, m in enumerate(messages)]
    spark.createDataFrame(data, KAFKA).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def stream(spark, path):
    return spark.readStream.schema(KAFKA).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_equals_batch_and_survives_a_restart(spark, folder):
    source, table = f"{folder}/in", MATCHES.table(spark, f"{folder}/table")

    def run():
        run_until_done([start_upserts(stream(spark, source), MATCHES, table, f"{folder}/cp", available_now=True)])

    drop_file(spark, folder, "in", [match(1, 1), match(1, 5, "FINISHED"), match(2, 1), "broken", match(2, 1, "TIMED")])
    run()
    shown = lambda: rows(table.current().select("match_id", "status"), "match_id")
    # The later of two equally new messages wins.
    assert shown() == [(1, "FINISHED"), (2, "TIMED")]
    assert "offset" not in table.current().columns
    assert rows(table.unreadable().select("raw_json")) == [("broken",)]
    run()  # nothing new
    drop_file(spark, folder, "in", [match(1, 2, "PAUSED"), match(3, 1)])
    run()
    # A late message in a later batch overwrites: the last writer wins.
    assert shown() == [(1, "PAUSED"), (2, "TIMED"), (3, "IN_PLAY")]
    # The same batches by hand give the same table.
    other = MATCHES.table(spark, f"{folder}/other")
    apply = upsert_batches(MATCHES, other, other.run_for("x"), compact_every=1)
    data = [(m, "t", 0, i, dt.datetime(2024, 1, 1)) for i, m in enumerate([match(1, 5, "FINISHED"), match(2, 1, "TIMED")])]
    apply(spark.createDataFrame(data, KAFKA), 0)
    apply(spark.createDataFrame([(match(1, 2, "PAUSED"),), (match(3, 1),)], "value string"), 1)
    apply(spark.createDataFrame([], "value string"), 2)
    assert rows(other.current().select("match_id", "status"), "match_id") == shown()


def test_batches_are_not_cached_and_lose_no_unreadable_message(spark, folder, monkeypatch):
    """Parsed messages in the cache filled the executors' memory; without it, every unreadable one is still stored, once."""

    def refused(*_):
        raise AssertionError("a batch was cached")

    monkeypatch.setattr(type(spark.range(1)), "persist", refused)
    monkeypatch.setattr(type(spark.range(1)), "cache", refused)
    table = MATCHES.table(spark, f"{folder}/table")
    apply = upsert_batches(MATCHES, table, table.run_for("x"), compact_every=0)
    batches = [[match(1, 1)], ["broken", "no"], [match(2, 1), "half"], [], [None]]
    for number, texts in enumerate(batches):
        apply(spark.createDataFrame([(x,) for x in texts], "value string"), number)
    expected = [("broken", 1), ("half", 2), ("no", 1), (None, 4)]
    found = lambda: sorted(rows(table.unreadable().select("raw_json", "batch")), key=str)
    assert found() == sorted(expected, key=str)
    table.compact()
    # Batch 2 is in the base now: a replay changes no row and stores its unreadable message again.
    assert table.covers(table.run_for("x"), 2)
    apply(spark.createDataFrame([(match(2, 9, "FINISHED"),), ("half",)], "value string"), 2)
    assert found() == sorted(expected, key=str)
    assert rows(table.current().select("match_id", "status"), "match_id") == [(1, "IN_PLAY"), (2, "IN_PLAY")]


def test_two_topics_in_one_session(spark, folder):
    competition = json.dumps({"id": 1, "name": "L", "code": "L", "lastUpdated": "2024-01-01T00:00:00Z"})
    table_row = {"position": 1, "team": {"id": 5, "name": "T"}, "points": 3}

    def standings(points, group):
        row = table_row | {"points": points}
        return json.dumps({"competition": {"id": 1, "name": "L"}, "season": {"id": 2}, "standings": [{"group": group, "table": [row]}]})

    drop_file(spark, folder, "c", [competition])
    drop_file(spark, folder, "s", [standings(3, None), standings(4, "")])
    tables = {}
    queries = []
    for topic, path in ((COMPETITIONS, "c"), (STANDINGS, "s")):
        tables[path] = topic.table(spark, f"{folder}/{path}-table")
        queries.append(start_upserts(stream(spark, f"{folder}/{path}"), topic, tables[path], f"{folder}/{path}-cp", available_now=True))
    run_until_done(queries)
    assert tables["c"].current().count() == 1 and tables["c"].unreadable() is None and tables["s"].unreadable() is None
    assert rows(tables["s"].current().select("team_id", "points")) == [(5, 4)]


def test_failed_batches_fail_the_query(spark, folder):
    drop_file(spark, folder, "in", [match(1, 1)])
    table = MATCHES.table(spark, f"{folder}/table")
    broken = stream(spark, f"{folder}/in").withColumn("value", F.raise_error(F.lit("boom")))
    query = start_upserts(broken, MATCHES, table, f"{folder}/cp", available_now=True)
    with pytest.raises(Exception, match="boom"):
        run_until_done([query])
    # Nothing was recorded, and the repaired query picks the batch up again.
    run_until_done([start_upserts(stream(spark, f"{folder}/in"), MATCHES, table, f"{folder}/cp", available_now=True)])
    assert table.current().count() == 1


def merge_plan(spark, folder, **kw):
    """Plan of an upsert of a few rows onto a stored table of many columns."""
    spark.range(5000).selectExpr("id k", "id % 7 v", *(f"concat('wide ', id + {i}) w{i}" for i in range(5))).write.parquet(f"{folder}/base")
    base = spark.read.parquet(f"{folder}/base")
    batch = base.where("k < 3").withColumn("v", F.lit(99).cast("bigint")).unionByName(base.where("k = 4999").withColumn("k", F.col("k") + 1))
    batch.write.parquet(f"{folder}/batch")
    return U.upsert(base, spark.read.parquet(f"{folder}/batch"), ["k"], **kw)


@pytest.mark.parametrize("updates", [None, ["v"]])
def test_merge_reads_the_wide_base_once_and_never_groups_it(spark, folder, updates):
    out = merge_plan(spark, folder, update_columns=updates)
    got = out.collect()
    assert len(got) == 5001 and {r.k: r.v for r in got if r.v == 99} == {0: 99, 1: 99, 2: 99}
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = [line for line in plan.splitlines() if "FileScan" in line and f"{folder}/base" in line]
    assert len(scans) == 2, plan
    wide = [line for line in scans if "w3" in line.split("ReadSchema")[1]]
    assert len(wide) == 1 and [line.split("ReadSchema: ")[1] for line in scans if line not in wide] == ["struct<k:bigint>"]
    assert "SortAggregate" not in plan


def test_merge_policies_null_keys_and_odd_names(spark):
    schema = "k int, g string, t int, `a.b` string"
    base = spark.createDataFrame([(1, None, 5, "old"), (2, "", None, "old"), (None, "x", 5, "old"), (4, "y", 5, "old")], schema)
    batch = spark.createDataFrame([(1, "", 4, "late"), (2, None, None, "new"), (None, "x", 5, "tie"), (4, "y", None, "untimed"), (5, None, None, "added")], schema)
    out = U.merge(base, batch, ["k", "g"], ["g"], event_time="t")
    assert {r.k: r["a.b"] for r in out.collect()} == {1: "old", 2: "new", None: "tie", 4: "old", 5: "added"}
    out = U.merge(base, batch, ["k", "g"], ["g"])
    assert {r.k: r["a.b"] for r in out.collect()} == {1: "late", 2: "new", None: "tie", 4: "untimed", 5: "added"}
    flagged = batch.withColumn("_partial", F.col("k") != 2)
    out = U.merge(base.withColumn("_partial", F.lit(False)), flagged, ["k", "g"], ["g"], update_columns=["t"])
    assert {r.k: (r.t, r["a.b"]) for r in out.collect()} == {1: (4, "old"), 2: (None, "new"), None: (5, "tie"), 4: (None, "old"), 5: (None, "added")}
    assert U.merge(base, batch.limit(0), ["k", "g"], ["g"]).count() == 4 and U.merge(base.limit(0), batch, ["k", "g"], ["g"]).count() == 5
    with pytest.raises(ValueError):
        U.upsert(base, batch, ["k"], policy="other")
    with pytest.raises(ValueError):
        U.upsert(base, batch, ["k"], policy=U.LATEST_EVENT)


@pytest.mark.parametrize("partial_share", [0.0, 0.6])
def test_store_with_mixed_batches_against_a_dictionary(spark, folder, partial_share):
    """Full and partial batches of one store, folded now and then, against a step-by-step merge."""
    rng = random.Random(9)
    table, state = UpsertTable(spark, f"{folder}/t", ["k"], update_columns=["b"], buckets=3), {}
    run = table.run_for("w")
    for batch_id in range(7):
        partial = rng.random() < partial_share
        batch = {rng.randrange(25): (rng.randrange(99), rng.choice([None, rng.randrange(99)])) for _ in range(12)}
        table.apply(spark.createDataFrame([(k, a, b) for k, (a, b) in batch.items()], "k int, a int, b int"), run, batch_id, partial=partial)
        for key, (a, b) in batch.items():
            state[key] = (state[key][0], b) if partial and key in state else (a, b)
        if batch_id in (2, 4):
            table.compact()
        assert {r.k: (r.a, r.b) for r in table.current().collect()} == state


@pytest.mark.parametrize("crowded_rows", [10**6, 60, 0])
def test_standings_files_cross_one_shuffle_and_match_a_pass_per_file(spark, crowded_rows):
    """Repeated, hot and null keys, '' for a null group, several files and several rows of a key in a file; with and without a state."""
    rng = random.Random(5)
    columns = [flat.name for flat in M.STANDING_LAYOUT]
    whole = ("competition_id", "season_id", "team_id", "points", "won")
    kinds = T.StructType([T.StructField(c, T.IntegerType() if c in whole else T.StringType()) for c in columns])

    def row(hot=False):
        given = {
            "competition_id": 1 if hot else rng.choice([1, 2, None]), "season_id": 2024, "team_id": 9 if hot else rng.randrange(40), "stage": "S", "standing_type": "TOTAL",
            "group_name": None if hot else rng.choice([None, "", "G"]), "competition_name": rng.choice(["A", "B", None]), "area_name": rng.choice(["x", None]),
            "team_name": rng.choice(["t", "u", None]), "points": rng.randrange(4), "won": rng.choice([None, 1, 2]), "current_matchday": rng.choice(["1", None]),
        }
        return tuple(given.get(c) for c in columns)

    def key(r):
        given = dict(zip(columns, r))
        return tuple((given[c] or "") if c == "group_name" else given[c] for c in STANDING_KEY)

    def first(found):
        return min(found, key=lambda r: [(v is None, v if v is not None else 0) for v in r])

    sent = [(row(), rng.choice("abc")) for _ in range(150)] + [(row(hot=True), rng.choice("abc")) for _ in range(100)]
    held = {key(r): r for r in (row() for _ in range(40))}
    files = spark.createDataFrame([(*r, f, "now") for r, f in sent], T.StructType([*kinds.fields, T.StructField("file", T.StringType()), T.StructField("processed_at", T.StringType())]))
    state = spark.createDataFrame([(*r, "then") for r in held.values()], T.StructType([*kinds.fields, T.StructField("processed_at", T.StringType())]))
    for before in ({}, held):
        want = {k: (*r, "then") for k, r in before.items()}
        for name in "abc":
            in_file = {}
            for r, f in sent:
                if f == name:
                    in_file.setdefault(key(r), []).append(r)
            for k, found in in_file.items():
                new = (*first(found), "now")
                old = want.get(k, new)
                want[k] = tuple(n if c in FILE_UPDATES else o for c, n, o in zip([*columns, "processed_at"], new, old))
        loaded = load_standings_files(state if before else None, files, "file", crowded_rows)
        assert loaded.columns == [*columns, "processed_at"]
        if crowded_rows == 10**6:
            assert loaded._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        assert sorted(rows(loaded), key=repr) == sorted(want.values(), key=repr)
