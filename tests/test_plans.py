"""Merges, joins and numberings against brute force, also with hot keys."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from pulsemill.operators import audit, merge
from pulsemill.plans.numbering import number_rows, time_levels
from pulsemill.plans.skew import hot_keys, skew_join
from pulsemill.session import scratch_path
from pulsemill.sources import chunks, ledger
from pulsemill.sources.store import Store, added


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a tenth on NULL."""
    random.seed(4)
    rows = [(i // 2, 0 if i % 3 == 0 else None if i % 10 == 1 else random.randrange(1, 900)) for i in range(3000)]
    return spark.createDataFrame(rows, "id bigint, k bigint").repartition(4), rows


def test_hot_keys_are_few(spark, skewed):
    frame, rows = skewed
    assert sorted(r[0] is None or r[0] for r in hot_keys(frame, ["k"], 20).collect()) == [0, True]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_skew_join(spark, skewed, table, how, null_safe):
    frame, rows = skewed
    known = [0, None] + list(range(1, 900, 2))
    right = spark.createDataFrame([(k, 7) for k in known], "k bigint, v int")
    right = right if how in ("inner", "left") else right.select("k")
    got = skew_join(frame, right, ["k"], how, null_safe=null_safe)

    def hit(k):
        return k in known and (null_safe or k is not None)

    expected = {
        "inner": [(i, 7) for i, k in rows if hit(k)],
        "left": [(i, 7 if hit(k) else None) for i, k in rows],
        "left_semi": [(i,) for i, k in rows if hit(k)],
        "left_anti": [(i,) for i, k in rows if not hit(k)],
    }[how]
    columns = ["id", "v"] if how in ("inner", "left") else ["id"]
    assert table(got, *columns) == sorted(expected, key=repr)


def test_number_rows(spark, skewed, table):
    frame, rows = skewed
    got = number_rows(frame, "n", ["id"], [F.floor(F.col("id") / 500), F.floor(F.col("id") / 50)], ["k"])
    expected, seen = [], {}
    for i, k in sorted(rows, key=lambda r: r[0]):
        seen[k] = seen.get(k, 0) + 1
        expected.append((i, seen[k]))
    assert table(got, "id", "n") == sorted(expected, key=repr)


def test_number_rows_by_time(spark, table):
    stamps = sorted({random.randrange(10**15, 10**15 + 3 * 10**11) for _ in range(400)})
    frame = spark.createDataFrame([(s,) for s in stamps], "us bigint").select("us", F.timestamp_micros("us").alias("ts"))
    got = number_rows(frame, "n", ["ts"], time_levels("ts"))
    assert dict(table(got, "us", "n")) == {s: i for i, s in enumerate(stamps, 1)}


@pytest.mark.parametrize("sets,smallest,most,sizes", [(2, 1, 2, [1, 1]), (7, 2, 3, [3, 2, 2]), (5, 2, 2, [3, 2]), (1, 2, 3, [1])])
def test_batches(spark, sets, smallest, most, sizes):
    frame = spark.range(sets).select(F.timestamp_seconds("id").alias("file_set_ts"))
    batches = ledger.assign_batches(frame, smallest, most).groupBy("batch_id").count().orderBy("batch_id")
    assert [r["count"] for r in batches.collect()] == sizes
    with pytest.raises(ValueError):
        ledger.assign_batches(frame, 0, 1)


def sequential(stored, sent, update=None, newer=False, ignore=False):
    """The writes one after the other: rows are (key, order, a, v)."""
    state = {r[0]: list(r[1:]) for r in stored}
    for key, order, a, v in sorted(sent, key=lambda r: r[1]):
        if key not in state:
            state[key] = [order, a, v]
        elif ignore:
            continue
        elif newer and not (v is not None and state[key][2] is not None and v > state[key][2]):
            continue
        else:
            old = state[key]
            state[key] = [old[0], a if update is None or "a" in update else old[1], v if update is None or "v" in update else old[2]]
    return {k: tuple(v[1:]) for k, v in state.items()}


@pytest.mark.parametrize("seed", range(3))
def test_merges_equal_single_statements(spark, seed):
    random.seed(seed)
    ddl = "k bigint, o bigint, a int, v int"

    def value():
        return random.choice([None, 1, 2, 3, 4, 5])

    stored = [(k, -1, value(), value()) for k in range(0, 60, 2)]
    sent = [(random.choice([2, 3, random.randrange(60)]), i, value(), value()) for i in range(400)]
    target = spark.createDataFrame(stored, ddl).select("k", "a", "v")
    source = spark.createDataFrame(sent, ddl).repartition(5)

    def state(frame):
        return {r.k: (r.a, r.v) for r in frame.collect()}

    assert state(merge.insert_ignore(target, source, ["k"], ["o"])) == sequential(stored, sent, ignore=True)
    assert state(merge.upsert(target, source, ["k"], ["o"])) == sequential(stored, sent)
    assert state(merge.upsert(target, source, ["k"], ["o"], update_columns=["v"])) == sequential(stored, sent, {"v"})
    assert state(merge.upsert(target, source, ["k"], ["o"], preserve=["v"])) == sequential(stored, sent, {"a"})
    assert state(merge.upsert(target, source, ["k"], ["o"], newer_on="v")) == sequential(stored, sent, newer=True)


def test_column_groups_overwrite_themselves_with_null(spark, table):
    target = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 4.0)], "k int, a double, b double")
    one = spark.createDataFrame([(1, 0, 9.0), (1, 1, None), (3, 0, 5.0)], "k int, o int, a double")
    two = spark.createDataFrame([(3, 0, 6.0)], "k int, o int, b double")
    got = merge.merge_column_groups(target, {"x": one, "y": two}, {"x": ["a"], "y": ["b"]}, ["k"], ["o"])
    assert table(got, "k", "a", "b") == [(1, None, 2.0), (2, 3.0, 4.0), (3, 5.0, 6.0)]


@pytest.mark.parametrize("mode,faithful,latest", [("ignore", False, [2]), ("ignore", True, []), ("update", False, [2])])
def test_latest_flag_on_replay(spark, mode, faithful, latest):
    target = spark.createDataFrame([(7, 1, "old", False), (7, 2, "old", True)], "u int, d int, t string, latest boolean")
    source = spark.createDataFrame([(7, 2, "new", 1)], "u int, d int, t string, o int")
    got = merge.maintain_latest_flag(target, source, ["u"], ["u", "d"], ["o"], mode, faithful=faithful)
    rows = {r.d: (r.t, r.latest) for r in got.collect()}
    assert [d for d in rows if rows[d][1]] == latest
    assert rows[2][0] == ("old" if mode == "ignore" else "new")
    assert audit.unique_latest_violations(got, ["u"]).count() == 0


def test_returning_rows_matches_null(spark, table):
    result = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    asked = spark.createDataFrame([(1,), (None,)], "k int")
    assert table(merge.returning_rows(result, asked, ["k"]), "v") == [("a",), ("b",)]


def test_chunks_are_pruned_and_compacted(spark):
    folder, packed = scratch_path(spark, "t"), scratch_path(spark, "t")
    rows = spark.range(2000).select(
        (F.col("id") % 5).alias("user_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 1800).alias("ts")
    )
    chunks.write_time_chunks(rows, folder, "ts", ["user_id"])
    stored = spark.read.parquet(folder)
    week = chunks.time_range(stored, "ts", "2024-01-11", "2024-01-18")
    assert week.count() == 7 * 48
    plan = week._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chunk" in plan
    now = F.lit("2024-02-20").cast("timestamp")
    chunks.compact_old_chunks(spark, folder, packed, "ts", ["user_id"], now)
    old = spark.read.parquet(packed)
    kept = chunks.drop_expired_chunks(stored, now, 30)
    assert old.count() + kept.count() == 2000 and old.select("chunk").distinct().count() == 3


def test_store_range_compaction_and_expiry(spark):
    store = Store(spark, scratch_path(spark, "store"))
    listed = {}
    for run in ("a", "b"):
        offset = 0 if run == "a" else 900
        rows = spark.range(1000).select(
            F.lit(7).cast("bigint").alias("user_id"),
            F.timestamp_seconds(F.lit(1704067200 + offset) + F.col("id") * 3600).alias("timestamp"),
            F.lit(60).alias("value"),
            F.lit(None).cast("timestamp").alias("create_ts"),
        )
        added(listed, "heart_rate", store.write("heart_rate", rows, run))
    store.publish(listed, 1)
    assert store.read_range("heart_rate", date(2024, 1, 11), date(2024, 1, 18)).count() == 2 * 7 * 24
    assert store.read_range("heart_rate", date(2024, 1, 12), date(2024, 1, 13)).count() == 2 * 24
    old = store.compact("heart_rate", date(2024, 2, 24))
    assert old == ["2023-12-28", "2024-01-04", "2024-01-11", "2024-01-18"]
    assert store.read("heart_rate").count() == 2000
    assert all(len(store.manifest()["heart_rate"][c]) == 1 for c in old)
    assert store.expire("heart_rate", date(2024, 2, 24), 40) == ["2023-12-28", "2024-01-04"]
    assert store.read("heart_rate").agg(F.min("chunk")).head()[0] == "2024-01-11"


def test_rollup_refresh_touches_only_its_chunks(spark):
    folder = scratch_path(spark, "rollup")
    rows = spark.range(1000).select(
        F.lit(1).alias("k"), F.lit(2).alias("v"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600).alias("ts")
    ).withColumn("chunk", chunks.chunk_of(F.col("ts")))
    all_chunks = [r[0] for r in rows.select("chunk").distinct().collect()]
    chunks.refresh_rollup(spark, rows, all_chunks, folder, "ts", "1 day", ["k"], "v")
    doubled = rows.withColumn("v", F.col("v") * 2)
    chunks.refresh_rollup(spark, doubled, all_chunks[:1], folder, "ts", "1 day", ["k"], "v")
    again = spark.read.parquet(folder)
    per_chunk = rows.filter(F.col("chunk") == all_chunks[0]).count()
    assert again.agg(F.sum("total")).head()[0] == 2000 + 2 * per_chunk


def test_file_set_pages_are_bounded_and_whole(spark):
    files = spark.range(2500).select(
        F.timestamp_seconds(F.lit(0)).alias("file_set_ts"),
        F.lit("SLEEP").alias("file_type"),
        F.concat(F.lit("/in/"), F.col("id").cast("string")).alias("path"),
    )
    pages = ledger.file_set_pages(files, 400)
    sizes = [len(r.files["SLEEP"]) for r in pages.collect()]
    assert sum(sizes) == 2500 and max(sizes) <= 400 and len(sizes) == 7
