"""The mailbox as a stream of whole file sets, each processed exactly once.

A micro-batch cuts the mailbox anywhere, but a file set succeeds or fails as a whole. So a batch only lands
its documents among the waiting ones, by epoch, and a set is released when it is complete: `hold` after its
time, measured by the newest set time seen, or at the end of an available-now drain, when every listed file
has been taken. All released sets are one run.

A run publishes its tables together with the stream's progress: the last epoch that counts and the time up
to which sets were released. A replayed epoch at or below that mark does nothing, and one that was landed
but not published is landed again over itself, so each document takes part in one published run. A file
that comes after its set was released is a late set of its own. Waiting documents are deleted once a drain
has released them all.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.plans.run import RunConfig, run_batch
from pulsemill.session import remove_folder
from pulsemill.sources.mailbox import RAW, stream_raw_documents, with_origin
from pulsemill.sources.store import Store

NO_HOLD = timedelta(0)


def drain(raw: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Hand every waiting file to `each` once, in micro-batches, and return when none is left."""
    query = (
        raw.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


class SetStream:
    """Documents that wait for their set, and the runs that take complete sets out."""

    def __init__(
        self, store: Store, waiting: str, config: RunConfig, decoded_frames: DataFrame | None = None, name: str = "mailbox"
    ):
        self.store, self.waiting, self.config, self.frames, self.name = store, waiting, config, decoded_frames, name

    def _marks(self) -> tuple[int, int | None]:
        """The last epoch that counts and the time, in microseconds, up to which sets were released."""
        marks = self.store.progress(self.name)
        return (int(marks[0]), int(marks[1])) if marks else (-1, None)

    def take(self, batch: DataFrame, epoch: int, hold: timedelta | None = None) -> bool:
        """Land the documents of an epoch and release what is complete; whether the epoch was new."""
        if epoch <= self._marks()[0]:
            return False
        timed = with_origin(batch).select(*batch.columns, F.unix_micros("file_set_ts").alias("set_time"))
        timed.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.waiting}/epoch={epoch}")
        if hold is not None:
            self.release(hold)
        return True

    def release(self, hold: timedelta = NO_HOLD) -> DataFrame | None:
        """Run the waiting sets whose time is `hold` before the newest one; None if there are none."""
        spark = self.store.spark
        if not _exists(spark, self.waiting):
            return None
        done, until = self._marks()
        rows = spark.read.schema(f"{RAW}, set_time bigint, epoch bigint").parquet(self.waiting)
        fresh = F.col("epoch") > done
        open_ = rows.filter(fresh if until is None else fresh | (F.col("set_time") > until))
        head = open_.agg(F.max("set_time").alias("newest"), F.max("epoch").alias("epoch"), F.min("set_time").alias("oldest")).first()
        if head["newest"] is None:
            return None
        now = head["newest"] - hold // timedelta(microseconds=1)
        if head["oldest"] > now:
            return None
        marks = [str(max(done, head["epoch"])), str(now if until is None else max(now, until))]
        ready = open_.filter(F.col("set_time") <= now).drop("set_time", "epoch")
        return run_batch(spark, ready, self.store, self.config, self.frames, (self.name, marks))

    def finish(self) -> DataFrame | None:
        """Release everything and delete the documents that waited."""
        outcome = self.release()
        remove_folder(self.store.spark, self.waiting)
        return outcome


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def stream_mailbox(
    spark: SparkSession,
    folder: str,
    store: Store,
    checkpoint: str,
    config: RunConfig,
    decoded_frames: DataFrame | None = None,
    files_per_batch: int | None = None,
    hold: timedelta | None = None,
) -> DataFrame | None:
    """Process all waiting files of the folder into the store; the outcome of the last run. With `hold`, sets
    are released while the drain goes on; without it, all of them at its end."""
    stream = SetStream(store, f"{checkpoint.rstrip('/')}-waiting", config, decoded_frames)

    def each(batch: DataFrame, epoch: int) -> None:
        stream.take(batch, epoch, hold)

    drain(stream_raw_documents(spark, folder, files_per_batch), checkpoint, each)
    return stream.finish()
