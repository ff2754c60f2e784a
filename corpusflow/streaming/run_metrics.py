"""Run metrics as a stream: time between steps and moving average carried across batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusflow.operators.runlog import ema, seconds_between, step_dt
from corpusflow.operators.scan import number_rows
from corpusflow.scratch import delete_path

STATE = "run_id bigint, last_ts timestamp, last_event bigint, last_ema double, iters bigint"


class RunMetricsSink:
    """Writes ``(run_id, iter, ts, event_id, loss, dt, ema)`` per micro-batch.

    A keyed streaming state would hand a run to one task, and one run may be a third of
    the stream.  Here every micro-batch is scanned with the batch operators, which split
    a run, and what a run carries over is a table.  Batch ``n`` reads the state that
    batch ``n - 1`` wrote and overwrites its own folders, so a repeated batch gives the
    same files.

    Rows that are not later than the last row of their run in an earlier batch are left
    out of the series and kept under ``late`` instead.
    """

    def __init__(self, path: str, alpha: float = 0.1) -> None:
        self.path, self.alpha = path.rstrip("/"), alpha

    def _state(self, spark: SparkSession, batch: int) -> DataFrame:
        if batch == 0:
            return spark.createDataFrame([], STATE)
        return spark.read.schema(STATE).parquet(f"{self.path}/state/batch={batch - 1}")

    def __call__(self, events: DataFrame, batch: int) -> None:
        spark = events.sparkSession
        before = self._state(spark, batch)
        seen = events.join(before, "run_id", "left")
        order = F.struct("ts", "event_id")
        on_time = F.col("last_ts").isNull() | (order > F.struct(F.col("last_ts").alias("ts"), F.col("last_event").alias("event_id")))
        late = seen.where(~on_time).select("run_id", "ts", "event_id", "loss")
        late.write.mode("overwrite").parquet(f"{self.path}/late/batch={batch}")

        steps = number_rows(seen.where(on_time), ["run_id"], ["ts", "event_id"], out="pos")
        timed = step_dt(steps, step="pos")
        averaged = ema(timed, alpha=self.alpha, step="pos", initial="last_ema")
        carried = F.when(F.col("pos") == 0, seconds_between(F.col("ts"), F.col("last_ts"))).otherwise(F.col("dt"))
        averaged.select(
            "run_id",
            (F.col("pos") + F.coalesce("iters", F.lit(0))).alias("iter"),
            "ts",
            "event_id",
            "loss",
            carried.alias("dt"),
            "ema",
        ).write.mode("overwrite").parquet(f"{self.path}/metrics/batch={batch}")

        written = spark.read.parquet(f"{self.path}/metrics/batch={batch}")
        new = written.groupBy("run_id").agg(
            F.max_by(F.struct("ts", "event_id"), "iter").alias("last"),
            F.max_by("ema", F.when(F.col("ema").isNotNull(), F.col("iter"))).alias("ema"),
            (F.max("iter") + 1).alias("count"),
        )
        after = before.join(new, "run_id", "full").select(
            "run_id",
            F.coalesce("last.ts", "last_ts").alias("last_ts"),
            F.coalesce("last.event_id", "last_event").alias("last_event"),
            F.coalesce("ema", "last_ema").alias("last_ema"),
            F.coalesce("count", "iters").alias("iters"),
        )
        after.write.mode("overwrite").parquet(f"{self.path}/state/batch={batch}")
        # a repetition of this batch needs the state before it, nothing needs older ones
        delete_path(spark, f"{self.path}/state/batch={batch - 2}")


def stream_run_metrics(events: DataFrame, path: str, alpha: float = 0.1) -> StreamingQuery:
    """Start the stream on ``(run_id, ts, event_id, loss)`` and process what is available.

    Started again on the same ``path`` it continues where it stopped.
    """
    rows = events.select(
        F.col("run_id").cast("bigint").alias("run_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("loss").cast("double").alias("loss"),
    )
    return (
        rows.writeStream.foreachBatch(RunMetricsSink(path, alpha))
        .option("checkpointLocation", f"{path.rstrip('/')}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def read_stream_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The series written so far."""
    return spark.read.parquet(f"{path.rstrip('/')}/metrics").drop("batch")
