from pyspark.sql import functions as F

from pulsemill.plans.run import RunConfig
from pulsemill.session import scratch_path
from pulsemill.sources import mailbox
from pulsemill.sources.store import Store
from pulsemill.streaming.mailbox import stream_mailbox

T = 1754524800000


def test_mailbox_is_read_once(spark):
    folder, checkpoint = scratch_path(spark, "box"), scratch_path(spark, "taken")
    store = Store(spark, scratch_path(spark, "store"))

    def land(name, content):
        frame = spark.createDataFrame([(name, content)], "file_name string, content string")
        mailbox.land_documents(frame, folder)

    def drain(run):
        stream_mailbox(spark, folder, store, checkpoint, RunConfig("wearables", run, "2025-08-08 03:00:00"))

    land("7_HEART_RATE_2025-08-07T12:00:00Z.json", f'{{"heartRateValues": [[{T}, 60]]}}')
    drain("a")
    land("7_HEART_RATE_2025-08-08T12:00:00Z.json", f'{{"heartRateValues": [[{T}, 99], [{T + 1000}, 61]]}}')
    drain("b")
    drain("c")
    rows = store.read("heart_rate").orderBy("timestamp").select("value").collect()
    assert [r[0] for r in rows] == [60, 61]
    names = store.read("etl_result").select("file_name", "dag_run_id").orderBy("file_name").collect()
    assert [tuple(r) for r in names] == [
        ("7_HEART_RATE_2025-08-07T12:00:00Z.json", "a"), ("7_HEART_RATE_2025-08-08T12:00:00Z.json", "b"),
    ]


def test_names_survive_landing(spark):
    name = F.lit("7_SLEEP_2025-08-07T12:00:00Z.json")
    safe, back = mailbox.safe_name(name), mailbox.original_name(mailbox.safe_name(name))
    row = spark.range(1).select(safe.alias("safe"), back.alias("back")).head()
    assert ":" not in row.safe and row.back == "7_SLEEP_2025-08-07T12:00:00Z.json"
