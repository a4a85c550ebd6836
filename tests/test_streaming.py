"""The keyed table and the progress ledger: split and repeated batches, crashes, restarts."""

import datetime as dt
import random

import pytest

from shelfloom.streaming import files
from shelfloom.streaming.incremental import ProgressLedger, each_batch, incremental_stats, incremental_upsert
from shelfloom.streaming.keyed import COMMIT, KeyedTable

SCHEMA = "id long, v long, x string, day string"


def keyed(spark, path):
    return KeyedTable(spark, f"{path}/t", spark.createDataFrame([], SCHEMA).schema, ["id"], ["v"], "day")


def rows_of(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


def merge(table, rows, *more):
    return table.merge(table.spark.createDataFrame(rows, SCHEMA), *more)


def test_a_partition_that_comes_in_parts_keeps_all_rows(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, rng.choice([1, 2, None]), rng.choice(["a", "b", None]), rng.choice(["d1", "d2", None])) for i in range(60)]
    batches = [rows[:20], rows[20:40], [], rows[40:], rows[:30]]
    want = sorted(rows, key=str)
    for order in (batches, batches[::-1]):
        table = keyed(spark, tmp_path / str(len(list(tmp_path.iterdir()))))
        assert rows_of(table) == []
        for b in order:
            assert merge(table, b)
        assert rows_of(table) == want


def test_newer_rows_stay_whatever_the_order_of_arrival(spark, tmp_path):
    one, two = keyed(spark, tmp_path / "a"), keyed(spark, tmp_path / "b")
    old, new = [(1, 1, "old", "d"), (2, 5, "only", "d"), (3, None, "none", "d")], [(1, 2, "new", "d"), (3, 0, "some", "d"), (None, 1, "null key", "d"), (None, 3, "null key", "d")]
    tie = [(2, 5, "tie", "d")]
    for b in (old, new, tie):
        merge(one, b)
    for b in (tie, new, old, new):
        merge(two, b)
    assert rows_of(one) == rows_of(two)
    got = {r[0]: r for r in rows_of(one)}
    assert got[1] == (1, 2, "new", "d") and got[3] == (3, 0, "some", "d") and got[None][1] == 3 and len(got) == 4


class Killed(Exception):
    pass


def test_a_run_that_dies_before_its_commit_changes_nothing(spark, tmp_path):
    class Dies(KeyedTable):
        left = 1

        def publish(self, number, commit):
            if self.left:
                self.left -= 1
                raise Killed
            super().publish(number, commit)

    table = keyed(spark, tmp_path)
    dies = Dies(spark, table.path, table.schema, table.keys, table.version, table.partition)
    merge(table, [(1, 1, "a", "d1"), (2, 1, "a", "d2")], 0, "s")
    before = rows_of(table)
    with pytest.raises(Killed):
        merge(dies, [(1, 2, "b", "d1"), (9, 1, "z", "d3")], 1, "s")
    assert rows_of(table) == before
    assert merge(dies, [(1, 2, "b", "d1"), (9, 1, "z", "d3")], 1, "s")
    assert not merge(table, [(1, 7, "replayed", "d1")], 1, "s"), "a batch that the ledger has is skipped"
    want = [(1, 2, "b", "d1"), (2, 1, "a", "d2"), (9, 1, "z", "d3")]
    assert rows_of(table) == want
    # d2 still stands where the first commit wrote it; the dead run's folder goes.
    gone = table.vacuum()
    assert sum(g.startswith("data/") for g in gone) == 1
    assert rows_of(table) == want
    folders = files.names(spark, f"{table.path}/data")
    assert len(folders) == 2 and all(f.startswith(f"{COMMIT}=") for f in folders)


def test_two_writers_cannot_take_one_number(spark, tmp_path):
    table = keyed(spark, tmp_path)
    merge(table, [(1, 1, "a", "d")])
    with pytest.raises(FileExistsError):
        table.publish(1, {"name": "other"})
    assert rows_of(table) == [(1, 1, "a", "d")]


def test_stream_that_dies_and_restarts_equals_the_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr("event_id", "ts", "event_type")
    events.repartition(3).write.parquet(f"{tmp_path}/in")
    table = KeyedTable(spark, f"{tmp_path}/t", events.schema, ["event_id"], ["ts"], "event_type")
    ledger = ProgressLedger(spark, f"{tmp_path}/progress")
    stream = lambda: spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    seen = []

    def dies(batch, i):
        table.merge(batch, i, "cp")
        seen.append(i)
        if seen == [0, 1]:
            raise Killed  # merged, but neither in the ledger nor in the checkpoint

    with pytest.raises(Exception):  # noqa: B017
        each_batch(stream(), dies, f"{tmp_path}/cp", ledger, "events", "ts").awaitTermination()
    each_batch(stream(), dies, f"{tmp_path}/cp", ledger, "events", "ts").awaitTermination()
    assert seen == [0, 1, 1, 2]
    incremental_upsert(stream(), table, f"{tmp_path}/other").awaitTermination()
    assert table.read().count() == events.count() and table.read().exceptAll(events).count() == 0
    r = incremental_stats(ledger, "events").first()
    ends = events.selectExpr("min(ts)", "max(ts)").first()
    assert (r.batches, r.rows) == (3, events.count()) and (r.first_time, r.last_time) == tuple(ends)


def test_ledger_holds_every_batch_over_restarts(spark, tmp_path):
    ledger = ProgressLedger(spark, f"{tmp_path}/progress")
    assert ledger.batches().collect() == [] and ledger.stats().collect() == []
    base = dt.datetime(2024, 1, 1)
    folder, n = tmp_path / "in", 0
    folder.mkdir()
    import pyarrow as pa
    import pyarrow.parquet as pq

    def arrive(k):
        nonlocal n
        for _ in range(k):
            pq.write_table(pa.table({"id": list(range(n % 7)), "at": pa.array([base + dt.timedelta(hours=n)] * (n % 7), pa.timestamp("us", tz="UTC"))}), folder / f"{n:04d}.parquet")
            n += 1

    def run():
        stream = spark.readStream.schema("id long, at timestamp").option("maxFilesPerTrigger", 1).parquet(str(folder))
        each_batch(stream, lambda b, i: None, f"{tmp_path}/cp", ledger, "d", "at").awaitTermination()

    arrive(80)
    run()
    arrive(70)
    run()
    run()
    assert ledger.batches().count() == 150
    r = incremental_stats(ledger, "d").first()
    assert (r.batches, r.rows) == (150, sum(i % 7 for i in range(150)))
    assert incremental_stats(ledger, "other").count() == 0


def test_a_large_batch_is_several_files_and_the_batches_stay_four(spark, monkeypatch):
    from shelfloom.plans import q_io

    monkeypatch.setattr(q_io, "FILE_ROWS", 100, raising=False)
    got = q_io._stats(spark, "/root/testdata/sf0.001").first()
    read = [f for f in spark.sparkContext._jvm.java.io.File(got_folder(spark)).list() if f.endswith(".parquet")]
    assert (got.batches, got.rows) == (4, spark.read.parquet("/root/testdata/sf0.001/events.parquet").count())
    assert len(read) > 4


def got_folder(spark):
    """Where the newest arrivals of incremental_stats were written."""
    from pathlib import Path

    base = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    return str(max(base.glob("stats-*/in"), key=lambda p: p.stat().st_mtime))
