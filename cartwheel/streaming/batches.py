"""Weekly-arrival processing as Structured Streaming.

Input: a landing folder that receives one parquet file per week.  Each job
reads it with ``readStream`` (explicit schema, one file per trigger), runs
with ``trigger(availableNow=True)`` and keeps its progress in a checkpoint
under the shared folder, so a restarted or retried job resumes exactly where
it stopped.  Sinks are written per micro-batch with the batch id in the
path (an idempotent overwrite), which makes retries exactly-once.
"""

from __future__ import annotations

import datetime
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.scalars import week_start
from cartwheel.session import shared_path

PROGRESS: list = []  # reports of the last query that ended
EVENT_SCHEMA = ("event_id long, customer_id long, product_id string, ts timestamp_ntz, value double, "
                "bought int, week date")


def land_weekly_files(events: DataFrame, path: str, resend_days: int = 1) -> list[str]:
    """Write the event view as one file per week, in week order; each file
    also re-sends the previous week's last ``resend_days`` days (at-least-once
    delivery) so de-duplication has work to do.  Returns the week list."""
    e = events.withColumn("week", week_start(F.col("ts")))
    weeks = [r[0] for r in e.select("week").distinct().orderBy("week").collect()]  # one row per week
    prev = None
    for w in weeks:
        cur = e.filter(F.col("week") == w)
        if prev is not None and resend_days > 0:
            tail = e.filter((F.col("week") == prev) & (F.to_date("ts") >= F.date_sub(F.lit(w), resend_days)))
            cur = cur.unionByName(tail)
        cur.select(*[c.split()[0] for c in EVENT_SCHEMA.split(", ")]).coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/week={w}")
        prev = w
    return [str(w) for w in weeks]


def _stream(spark: SparkSession, path: str) -> DataFrame:
    return (spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(path))


def _fresh(spark: SparkSession, path: str, delay: str = "8 days") -> DataFrame:
    """The stream without re-sent events, which arrive under the same id; the
    watermark bounds the ids that are kept."""
    # watermarks need zone-aware event time; the session zone is UTC
    return (_stream(spark, path).withColumn("et", F.col("ts").cast("timestamp")).withWatermark("et", delay)
            .dropDuplicatesWithinWatermark(["event_id"]))


def _run(query_builder, ckpt: str):
    """Run to the end of the available files; the query's progress reports are kept in ``PROGRESS``."""
    q = query_builder.option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    PROGRESS[:] = q.recentProgress


# R1
def ingest_batches(spark: SparkSession, landing: str, sink: str, ckpt: str) -> DataFrame:
    """Validate each arriving batch, append the valid rows once, and record
    (week, rows, valid, rejected) per batch."""
    def per_batch(df: DataFrame, batch_id: int):
        ok = df.customer_id.isNotNull() & df.product_id.isNotNull() & df.ts.isNotNull() & df.value.isNotNull()
        df = df.drop("et").persist()  # a stateful result is made once for both writes
        df.filter(ok).write.mode("overwrite").parquet(f"{sink}/rows/batch={batch_id}")
        df.groupBy("week").agg(F.count(F.lit(1)).alias("rows"), F.count_if(ok).alias("valid"),
                                  F.count_if(~ok).alias("rejected")) \
            .write.mode("overwrite").parquet(f"{sink}/metrics/batch={batch_id}")
        df.unpersist()
    _run(_fresh(spark, landing).writeStream.foreachBatch(per_batch), ckpt)
    return spark.read.parquet(f"{sink}/metrics")


# R2
def stream_weekly_activity(spark: SparkSession, landing: str, sink: str, ckpt: str, delay: str = "8 days") -> DataFrame:
    """A1 over the stream: Monday-aligned 7-day tumbling windows per
    (customer, product) with a watermark; update mode, each batch's changed
    windows appended under its batch id, the latest version per key wins."""
    s = _fresh(spark, landing, delay)
    agg = s.groupBy(F.window("et", "7 days", "7 days", "4 days").alias("w"), "customer_id", "product_id").agg(
        F.count(F.lit(1)).alias("num_tx"))

    def per_batch(df: DataFrame, batch_id: int):
        df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
    _run(agg.writeStream.outputMode("update").foreachBatch(per_batch), ckpt)
    ch = spark.read.parquet(sink)
    latest = ch.groupBy("w", "customer_id", "product_id").agg(F.max_by("num_tx", "batch_id").alias("num_tx"))
    return latest.select("customer_id", "product_id", F.to_date(F.col("w.start")).alias("week"),
                         F.col("num_tx").cast("bigint").alias("num_tx"), F.lit(1).alias("bought"))


# R3
def stream_dedupe(spark: SparkSession, landing: str, sink: str, ckpt: str, delay: str = "8 days") -> DataFrame:
    """Re-delivered events dropped across batches (state bounded by the watermark)."""
    s = _fresh(spark, landing, delay)
    _run(s.drop("et").writeStream.format("parquet").option("path", sink), ckpt)
    return spark.read.schema(EVENT_SCHEMA).parquet(sink)


# R4
STATE_OUT = "customer_id long, product_id string, opened long, last_period date, n_events long, closed boolean"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_recency(spark: SparkSession, landing: str, sink: str, ckpt: str, idle: str = "28 days") -> DataFrame:
    """Running last purchase date and purchase count per pair across batches, in
    per-key state with an end (``transformWithState``, update mode).

    A pair's state has an event-time timer.  When the watermark is ``idle`` past
    its last event the pair's row goes to the sink as closed and its state is
    removed, so the state holds the pairs of the last weeks, not all that ever
    bought.  A later event opens a new stretch; the answer adds the stretches
    of a pair, of each of which the latest version counts.

    Each call of the state store is a message between processes and each batch
    makes them for every pair, so a pair that is known costs one read and one
    write: its timer stays, and moves on only when it goes off too early."""
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    from pyspark.sql import Row
    from pyspark.sql.streaming import StatefulProcessor
    epoch = datetime.date(1970, 1, 1)

    class Recency(StatefulProcessor):  # nested: tasks receive it by value
        def init(self, handle):
            self.handle = handle
            self.pair = handle.getValueState("pair", "opened long, last_ms long, n_events long")

        def row(self, key, opened, last, n, closed):
            return Row(customer_id=key[0], product_id=key[1], opened=opened,
                       last_period=epoch + datetime.timedelta(days=last // 86_400_000), n_events=n, closed=closed)

        def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
            opened, last, n = self.pair.get() or (None, None, 0)
            new = opened is None
            for r in rows:
                opened = r.ms if opened is None else opened
                last = r.ms if last is None else max(last, r.ms)
                n += 1
            self.pair.update((opened, last, n))
            if new:
                self.handle.registerTimer(last + idle_ms)
            yield self.row(key, opened, last, n, False)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
            state = self.pair.get()
            if state is None:
                return
            opened, last, n = state
            if last + idle_ms > timerValues.getCurrentWatermarkInMs():  # bought since
                self.handle.registerTimer(last + idle_ms)
                return
            self.pair.clear()
            yield self.row(key, opened, last, n, True)

        def close(self):
            pass

    s = _fresh(spark, landing).select("customer_id", "product_id", "et", F.unix_millis("et").alias("ms"))
    out = s.groupBy("customer_id", "product_id").transformWithState(Recency(), STATE_OUT, "Update", "EventTime")

    def per_batch(df: DataFrame, batch_id: int):
        df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
    # states with timers need the RocksDB store; the setting is this query's alone
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        _run(out.writeStream.outputMode("update").foreachBatch(per_batch), ckpt)
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
    ch = spark.read.parquet(sink)
    stretch = ch.groupBy("customer_id", "product_id", "opened").agg(
        F.max_by(F.struct("last_period", "n_events"), F.struct("batch_id", "closed")).alias("s"))
    return stretch.groupBy("customer_id", "product_id").agg(F.max("s.last_period").alias("last_period"), F.sum("s.n_events").alias("n_events"))


# R5
def stream_drift(spark: SparkSession, landing: str, sink: str, ckpt: str, ref: DataFrame, label_expr,
                 threshold: float = 0.1) -> DataFrame:
    """D1 per arriving batch against a reference frame."""
    ref_rate = ref.agg(F.avg(label_expr.cast("double")).alias("ref_rate"))

    def per_batch(df: DataFrame, batch_id: int):
        new = df.groupBy("week").agg(F.avg(label_expr.cast("double")).alias("new_rate"))
        rel = F.abs(F.col("new_rate") - F.col("ref_rate")) / F.greatest(F.col("ref_rate"), F.lit(1e-6))
        new.crossJoin(F.broadcast(ref_rate)).select(
            "week", F.round("ref_rate", 6).alias("ref_rate"), F.round("new_rate", 6).alias("new_rate"),
            F.round(rel, 6).alias("rel_change"), F.when(rel >= threshold, "retrain").otherwise("skip").alias("decision")
        ).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
    _run(_fresh(spark, landing).writeStream.foreachBatch(per_batch), ckpt)
    return spark.read.parquet(sink).drop("batch")


def fresh_run_dirs(spark: SparkSession, name: str) -> dict[str, str]:
    """Unique landing / sink / checkpoint folders under the shared folder."""
    base = shared_path(spark, f"stream_{name}_{uuid.uuid4().hex[:10]}")
    return {"landing": f"{base}/landing", "sink": f"{base}/sink", "ckpt": f"{base}/checkpoint"}
