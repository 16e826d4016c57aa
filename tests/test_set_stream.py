"""Whole sets out of micro-batches, exactly once; plain inserts; constraints of a run."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from pulsemill.operators import constraints, merge
from pulsemill.plans.run import RunConfig, run_batch
from pulsemill.schema import APPEND, TABLES, Table
from pulsemill.session import scratch_path
from pulsemill.sources import mailbox
from pulsemill.sources.store import Store
from pulsemill.streaming.mailbox import SetStream, stream_mailbox

T = 1754524800000


def config(run="r1", **extra):
    return RunConfig("wearables", run, "2025-08-08 03:00:00", **extra)


def readings(day, *values):
    return {f"{u}_HEART_RATE_2025-08-{day:02}T12:00:00Z.json": f'{{"heartRateValues": [[{T + 1000 * day + u}, {v}]]}}' for u, v in enumerate(values, 1)}


def state(store):
    return sorted(map(tuple, store.state_digest().collect()))


def test_micro_batches_equal_one_batch(spark, raw):
    """Sets are cut over micro-batches of one file each; a broken file takes its whole set away."""
    files = {**readings(7, 60, 61, 62), **readings(8, 70), **readings(9, 80, 81)}
    files["9_HEART_RATE_2025-08-09T12:00:00Z.json"] = '{"heartRateValues": [[1]]}'
    folder, small, whole = (scratch_path(spark, name) for name in ("box", "small", "whole"))
    frame = spark.createDataFrame(list(files.items()), "file_name string, content string")
    mailbox.land_documents(frame, folder)
    stores = []
    for root, size in ((small, 1), (whole, None)):
        stores.append(Store(spark, root))
        stream_mailbox(spark, folder, stores[-1], scratch_path(spark, "taken"), config(), files_per_batch=size)
    assert state(stores[0]) == state(stores[1])
    assert stores[0].version() == 1
    assert sorted(r.value for r in stores[0].read("heart_rate").collect()) == [60, 61, 62, 70]
    direct = Store(spark, scratch_path(spark, "direct"))
    run_batch(spark, raw(files), direct, config())
    assert state(direct) == state(stores[0])


def test_batches_do_not_grow_with_the_files(spark, monkeypatch):
    """A batch has a fixed cost: past MOST_BATCHES batches they grow larger and not more. No file is lost."""
    files = {}
    for user in range(1, 42):
        files |= {f"{user}_HEART_RATE_2025-08-07T12:00:00Z.json": f'{{"heartRateValues": [[{T + user}, {user}]]}}'}
    folder, store = scratch_path(spark, "box"), Store(spark, scratch_path(spark, "store"))
    mailbox.land_documents(spark.createDataFrame(list(files.items()), "file_name string, content string"), folder)
    epochs, take = [], SetStream.take
    monkeypatch.setattr(SetStream, "take", lambda self, batch, epoch, hold: epochs.append(epoch) or take(self, batch, epoch, hold))
    stream_mailbox(spark, folder, store, scratch_path(spark, "taken"), config(), files_per_batch=1)
    assert epochs == list(range(21)) and len(epochs) <= mailbox.MOST_BATCHES
    assert sorted(r.value for r in store.read("heart_rate").collect()) == list(range(1, 42))


def test_a_replayed_epoch_publishes_nothing(spark, raw):
    store = Store(spark, scratch_path(spark, "store"))
    stream = SetStream(store, scratch_path(spark, "waiting"), config())
    day = timedelta(days=1)
    first, second = raw({**readings(7, 60), **readings(8, 70)}), raw({**readings(8, 70, 71), **readings(9, 80)})
    # The set of the 8th is still open after the first epoch and is released whole by the second.
    assert stream.take(first, 0, day)
    assert [r.value for r in store.read("heart_rate").collect()] == [60]
    before, version = state(store), store.version()
    assert not stream.take(first, 0, day)
    assert (state(store), store.version()) == (before, version)
    assert stream.take(second, 1, day)
    assert sorted(r.value for r in store.read("heart_rate").collect()) == [60, 70, 71]
    before, version = state(store), store.version()
    assert not stream.take(second, 1, day) and (state(store), store.version()) == (before, version)
    # An epoch that was landed and not published is landed again over itself.
    late = raw(readings(7, 0, 65))
    stream.take(late, 2)
    stream.take(late, 2)
    assert stream.finish() is not None and stream.finish() is None
    assert sorted(r.value for r in store.read("heart_rate").collect()) == [60, 65, 70, 71, 80]
    assert store.read("etl_result").count() == 5


def one_by_one(stored, units, keys):
    """Plain inserts in turn: a unit takes effect whole or not at all."""
    stored, failed = list(stored), []
    for unit, rows in sorted(units.items()):
        have = {k for k, _ in stored if k is not None}
        own = [k for k, _ in rows if k is not None]
        if have & set(own) or len(own) != len(set(own)):
            failed.append(unit)
        else:
            stored += rows
    return sorted(stored, key=repr), failed


@pytest.mark.parametrize("seed", range(4))
def test_plain_insert_equals_one_by_one(spark, seed):
    import random

    rng = random.Random(seed)
    stored = [(k, "old") for k in rng.sample(range(60), 4)]
    units = {u: [(rng.choice([None, *range(60)]), f"u{u}") for _ in range(rng.randint(1, 6))] for u in range(14)}
    target = spark.createDataFrame(stored, "k int, v string")
    rows = [(u, k, v) for u, own in units.items() for k, v in own]
    source = spark.createDataFrame(rows, "unit int, k int, v string")
    table, failed = merge.insert_plain(target, source, ["k"], ["unit"])
    want, lost = one_by_one(stored, units, ["k"])
    assert sorted(map(tuple, table.collect()), key=repr) == want
    assert sorted(r.unit for r in failed.collect()) == lost


def test_plain_insert_of_nothing(spark):
    none = spark.createDataFrame([], "unit int, k int, v string")
    table, failed = merge.insert_plain(none.drop("unit"), none, ["k"], ["unit"])
    assert table.count() == 0 and failed.count() == 0


def test_constraint_rules(spark):
    table = Table("line", "k int, n int, mode string", ("k", "n"), APPEND, required=("mode",), parent=("order", "k"))
    rows = spark.createDataFrame(
        [("a", 1, 1, "x"), ("a", 1, 1, "y"), ("b", 2, 1, None), ("b", 2, 2, None), ("c", 9, 1, "x"), ("d", None, 1, "x"), ("e", 1, 3, "x")],
        "file_name string, k int, n int, mode string",
    )
    orders = spark.createDataFrame([(1,), (2,)], "k int")
    found = constraints.findings(rows, table, orders, plain=True, origin=["file_name"])
    assert sorted(map(tuple, found.collect())) == [
        ("a", "line key is repeated"), ("b", "line.mode is missing"), ("c", "line has no order"), ("d", "line.k is missing"),
    ]
    assert constraints.findings(rows.limit(0), table, orders, plain=True, origin=["file_name"]).count() == 0


def test_a_run_enforces_required_columns(spark, raw):
    """An own decoder that forgets a required column costs the set, not the table."""
    from pulsemill.operators import wellness
    from pulsemill.operators.documents import Decoded
    from pulsemill.plans.run import DECODERS

    def careless(docs):
        decoded = wellness.decode_heart_rate(docs)
        return Decoded({k: r.withColumn("timestamp", F.when(F.col("value") < 70, F.col("timestamp"))) for k, r in decoded.rows.items()}, decoded.failures)

    assert "timestamp" in TABLES["heart_rate"].required
    store = Store(spark, scratch_path(spark, "store"))
    outcome = run_batch(spark, raw({**readings(7, 60), **readings(8, 70)}), store, config(decoders={**DECODERS, "HEART_RATE": careless}))
    assert {(r.success, r.error_type) for r in outcome.collect()} == {(True, None), (False, "heart_rate.timestamp is missing")}
    assert [r.value for r in store.read("heart_rate").collect()] == [60]
