"""Confirmation outcomes over two event streams (sent messages, replies).

Each trigger appends its events to a folder of its own, by time bucket (one bucket
is at least one timeout wide) and then runs the batch matcher
(:func:`ledgerlens.plans.confirm.confirm_outcomes`) over the buckets that closed
with it: a message of bucket c needs replies of c and c + 1 only, so c is closed
once the highest event time less the allowed delay is past c + 1. No state is
held per contact, no message is paired with all replies, and no Python runs on
the rows.

What a trigger leaves behind is a one-row progress table: the last closed bucket,
the newest time, late rows so far, and the event folders, those that still hold
rows of open buckets apart from the others. A trigger reads the progress of the one
before it and the open folders, nothing else, so its work does not grow with the
history. Every ``MERGE_FOLDERS`` closed folders are merged into one (and as many
merged ones into a larger one), so the list of folders grows with the logarithm of
the triggers. A trigger that is run again after a failure overwrites its own
folders, so outcomes appear once; :meth:`ConfirmTables.vacuum` removes event folders that
were merged.

Rows later than the allowed delay (their bucket is closed already) are counted
in the progress table and kept in the events. A finite run ends with
:func:`close_tail`, which matches the messages of all buckets still open, the late
messages, and again those of closed buckets that a later reply can answer; so every
message has exactly one outcome, the one the batch matcher gives over all events.
The buckets matched again are listed in a table of their own, and
:meth:`ConfirmTables.outcomes` leaves out what triggers wrote for them. While the
stream runs, a late reply does not change an outcome that is written.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.constants import CONFIRM_DEFAULT_TIMEOUT_SECONDS
from ledgerlens.plans.confirm import confirm_outcomes, epoch_micros
from ledgerlens.session import checkpoint_dir, subdir

TAIL = 1 << 40
NEVER = -(1 << 62)
MERGE_FOLDERS = 16
PROGRESS = ("epoch long, closed_to long, newest_us long, late_messages long, late_replies long, "
            "open array<struct<folder: string, high: long>>, closed array<struct<folder: string, level: int>>")


@dataclass(frozen=True)
class Progress:
    """What a trigger leaves to the next. ``open``: (folder, highest bucket); ``closed``: (folder, level of merging)."""

    epoch: int = -1
    closed_to: int | None = None
    newest_us: int | None = None
    late_messages: int = 0
    late_replies: int = 0
    open: tuple[tuple[str, int], ...] = ()
    closed: tuple[tuple[str, int], ...] = ()

    @property
    def folders(self) -> list[str]:
        return [f for f, _ in self.open + self.closed]

    def after(self, epoch: int, closed_to: int | None, newest_us: int | None, late: tuple[int, int],
              own: tuple[str, int] | None, merge: int = MERGE_FOLDERS) -> tuple[Progress, list[tuple[str, list[str]]]]:
        """The next progress, and the merges it needs: (folder to write, folders to read)."""
        held = self.open + ((own,) if own else ())
        still = tuple(x for x in held if closed_to is None or x[1] > closed_to)
        closed = list(self.closed) + [(f, 0) for f, high in held if (f, high) not in still]
        merges, level = [], 0
        while True:
            some = [f for f, at in closed if at == level]
            if len(some) < merge:
                break
            merged = f"part=merged-{epoch}-{level + 1}"
            merges.append((merged, some))
            closed = [x for x in closed if x[1] != level] + [(merged, level + 1)]
            level += 1
        return Progress(epoch, closed_to, newest_us, self.late_messages + late[0], self.late_replies + late[1], still,
                        tuple(closed)), merges


def _events(sent: DataFrame, replies: DataFrame, bucket_us: int) -> DataFrame:
    """Messages and replies as one table with the time bucket ``c``."""
    def side(df: DataFrame, kind: str, ts: str, key: str, text) -> DataFrame:
        us = epoch_micros(df, ts)
        return df.select(F.lit(kind).alias("kind"), F.col(key).alias("id"), "contact_id", F.col(ts).alias("ts"),
                         text.alias("text"), us.alias("us"), F.floor(us / bucket_us).alias("c"))

    return side(sent, "message", "sent_ts", "message_id", F.lit(None).cast("string")).unionByName(
        side(replies, "reply", "reply_ts", "reply_id", F.col("reply_text")))


class ConfirmTables:
    """The tables of one streaming job below ``folder``: events, outcomes, progress."""

    def __init__(self, spark: SparkSession, folder: str, sent: DataFrame, replies: DataFrame, *,
                 timeout_seconds: int, delay_seconds: int):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.timeout_seconds = timeout_seconds
        self.bucket_us = timeout_seconds * 1_000_000
        self.delay_us = delay_seconds * 1_000_000
        self.input = _events(sent, replies, self.bucket_us)
        self.schema = self.input.schema

    def path(self, table: str, epoch: int | None = None) -> str:
        return f"{self.folder}/{table}" if epoch is None else f"{self.folder}/{table}/trigger={epoch}"

    def progress(self, epoch: int | None = None) -> Progress:
        """The progress after one trigger, read from its own folder; without ``epoch`` the last there is."""
        try:
            rows = self.spark.read.schema(PROGRESS).parquet(self.path("progress", epoch))
            row = rows.orderBy(F.desc("epoch")).first()
        except Exception as missing:  # no trigger has finished yet
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            row = None
        if row is None:
            return Progress() if epoch is None or epoch < 0 else self.progress()
        return Progress(row["epoch"], row["closed_to"], row["newest_us"], row["late_messages"], row["late_replies"],
                        tuple((x["folder"], x["high"]) for x in row["open"]),
                        tuple((x["folder"], x["level"]) for x in row["closed"]))

    def events(self, folders: Sequence[str]) -> DataFrame:
        """The events of these folders, with the bucket that was closed when they came in (``closed_before``)."""
        schema = T.StructType([*self.schema.fields, T.StructField("closed_before", T.LongType())])
        if not folders:
            return self.spark.createDataFrame([], schema)
        root = self.path("events")
        return self.spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{f}" for f in folders]).drop("part")

    def _write_events(self, rows: DataFrame, folder: str) -> None:
        rows.hint("rebalance", "c").write.mode("overwrite").partitionBy("c").parquet(f"{self.path('events')}/{folder}")

    def trigger(self, batch: DataFrame, epoch: int) -> None:
        """Appends a trigger's events and writes the outcomes of the buckets that close with it."""
        before = self.progress(epoch - 1) if epoch else Progress()
        closed, folder = before.closed_to, f"part=trigger-{epoch}"
        self._write_events(batch.withColumn("closed_before", F.lit(NEVER if closed is None else closed).cast("long")), folder)
        late = F.col("c") <= F.lit(closed)
        seen = self.events([folder]).agg(
            F.max("us").alias("newest"), F.max("c").alias("high"),
            F.count_if(late & (F.col("kind") == "message")).alias("messages"),
            F.count_if(late & (F.col("kind") == "reply")).alias("replies")).first()
        times = [t for t in (seen["newest"], before.newest_us) if t is not None]
        newest = max(times) if times else None
        now_closed = closed
        own = (folder, seen["high"]) if seen["high"] is not None else None
        if newest is not None:
            done = math.floor((newest - self.delay_us) / self.bucket_us) - 2
            if closed is None or done > closed:
                now_closed = done
                first = NEVER if closed is None else closed + 1
                read = [f for f, _ in before.open] + ([folder] if own else [])
                self._match(self.events(read), self.path("outcomes", epoch), F.col("c").between(first, done),
                            F.col("c").between(first, done + 1))
        now, merges = before.after(epoch, now_closed, newest, (seen["messages"], seen["replies"]), own)
        for merged, some in merges:
            self._write_events(self.events(some), merged)
        row = (now.epoch, now.closed_to, now.newest_us, now.late_messages, now.late_replies, list(now.open), list(now.closed))
        self.spark.createDataFrame([row], PROGRESS).coalesce(1).write.mode("overwrite").parquet(self.path("progress", epoch))

    def _match(self, events: DataFrame, path: str, of_messages, of_replies) -> None:
        messages = events.filter((F.col("kind") == "message") & of_messages).select(
            F.col("id").alias("message_id"), "contact_id", F.col("ts").alias("sent_ts"))
        replies = events.filter((F.col("kind") == "reply") & of_replies).select(
            F.col("id").alias("reply_id"), "contact_id", F.col("ts").alias("reply_ts"), F.col("text").alias("reply_text"))
        confirm_outcomes(messages, replies, timeout_seconds=self.timeout_seconds).write.mode("overwrite").parquet(path)

    def close_tail(self) -> None:
        """Outcomes of every message without one, and again of closed buckets that got replies after they closed."""
        last = self.progress()
        closed = last.closed_to
        events, tail = self.events(last.folders), F.lit(True)
        reopened = self.spark.createDataFrame([], "c long")
        if closed is not None:
            # a message is late if its bucket had closed before its own trigger
            before = F.col("closed_before")
            # a reply of bucket c answers messages of c and c - 1
            reopened = events.filter(F.col("kind") == "reply").select(
                before.alias("before"), F.explode(F.array("c", F.col("c") - 1)).alias("c")).filter(
                F.col("c") <= F.col("before")).select("c").distinct()
            events = events.join(reopened.withColumn("again", F.lit(True)), "c", "left")
            tail = (F.col("c") > closed) | (F.col("c") <= before) | F.col("again").isNotNull()
        self._match(events, self.path("outcomes", TAIL), tail, F.lit(True))
        reopened.write.mode("overwrite").parquet(self.path("reopened"))

    def vacuum(self) -> list[str]:
        """Removes the event folders that were merged; those of the last two triggers' progress stay. Their names."""
        last = self.progress()
        named = set(last.folders) | (set(self.progress(last.epoch - 1).folders) if last.epoch > 0 else set())
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.path("events"))
        fs = root.getFileSystem(conf)
        gone = [x.getPath() for x in fs.listStatus(root) if x.isDirectory() and x.getPath().getName() not in named
                and _epoch_of(x.getPath().getName()) < last.epoch]
        for path in gone:
            fs.delete(path, True)
        return sorted(p.getName() for p in gone)

    def outcomes(self) -> DataFrame:
        """The outcomes; for buckets that the tail matched again, the tail's."""
        rows = self.spark.read.parquet(self.path("outcomes"))
        try:
            reopened = self.spark.read.schema("c long").parquet(self.path("reopened"))
        except Exception as missing:  # the tail is not closed
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return rows.drop("trigger")
        first = rows.filter(F.col("trigger") != TAIL)
        first = first.withColumn("c", F.floor(epoch_micros(first, "sent_ts") / self.bucket_us)).join(
            reopened, "c", "left_anti").drop("c")
        return first.unionByName(rows.filter(F.col("trigger") == TAIL)).drop("trigger")

    def late(self) -> tuple[int, int]:
        """How many messages and replies came after their bucket had closed."""
        last = self.progress()
        return last.late_messages, last.late_replies


def _epoch_of(folder: str) -> int:
    """The trigger that wrote an event folder (``part=trigger-7``, ``part=merged-7-1``)."""
    return int(folder.split("-")[1])


def start_confirm_stream(spark: SparkSession, sent: DataFrame, replies: DataFrame, *, folder: str,
                         name: str = "confirm_outcomes", timeout_seconds: int = CONFIRM_DEFAULT_TIMEOUT_SECONDS,
                         delay_seconds: int = 3600, available_now: bool = False,
                         checkpoint: str | None = None) -> tuple[StreamingQuery, ConfirmTables]:
    """Runs the streaming outcomes into tables below ``folder``.

    Progress is checkpointed below the cluster's shared ``spark.checkpoint.dir``
    (one folder per output), so a restarted job resumes where it was.
    """
    tables = ConfirmTables(spark, folder, sent, replies, timeout_seconds=timeout_seconds, delay_seconds=delay_seconds)
    digest = hashlib.sha1(tables.folder.encode("utf-8")).hexdigest()[:16]
    ckpt = checkpoint or subdir(checkpoint_dir(spark), "streams", f"{name}-{digest}")
    w = (tables.input.writeStream.foreachBatch(tables.trigger).option("checkpointLocation", ckpt).queryName(name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start(), tables


def run_to_end(spark: SparkSession, sent: DataFrame, replies: DataFrame, **options) -> ConfirmTables:
    """A finite run: all input there is, then the tail; every message has an outcome."""
    query, tables = start_confirm_stream(spark, sent, replies, available_now=True, **options)
    query.awaitTermination()
    tables.close_tail()
    return tables


def main(argv: list[str]) -> int:
    """``spark-submit ledgerlens/streaming/confirm_stream.py config.json`` with::

        {"sent": "s3://.../sent/", "replies": "s3://.../replies/", "output": "s3://.../outcomes/",
         "timeout_seconds": 300, "delay_seconds": 3600, "available_now": false}

    ``sent`` and ``replies`` are Parquet folders that keep receiving files with the
    batch schemas (``message_id, contact_id, sent_ts`` and ``reply_id, contact_id,
    reply_ts, reply_text``). With ``available_now`` the run is finite and closes its tail.
    """
    import json

    with open(argv[1], encoding="utf-8") as f:
        cfg = json.load(f)
    spark = SparkSession.builder.appName("ledgerlens-confirm-stream").getOrCreate()
    sent, replies = (spark.readStream.schema(spark.read.parquet(cfg[k]).schema).parquet(cfg[k])
                     for k in ("sent", "replies"))
    options = dict(folder=cfg["output"], timeout_seconds=int(cfg.get("timeout_seconds", CONFIRM_DEFAULT_TIMEOUT_SECONDS)),
                   delay_seconds=int(cfg.get("delay_seconds", 3600)))
    if cfg.get("available_now", False):
        run_to_end(spark, sent, replies, **options)
    else:
        start_confirm_stream(spark, sent, replies, **options)[0].awaitTermination()
    return 0


if __name__ == "__main__":
    import sys

    sys.exit(main(sys.argv))
