"""New-best steps of runs while they arrive, with keyed state in the state store."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from ..session import new_path
from .live import LATE, _states, _triggers

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def staircase(step: np.ndarray, loss: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The steps whose loss is strictly below that of every earlier step, ascending. Steps that are none stay none, whatever else arrives."""
    order = np.lexsort((loss, step))
    step, loss = step[order], loss[order]
    below = np.ones(len(loss), bool)
    below[1:] = loss[1:] < np.minimum.accumulate(loss)[:-1]
    return step[below], loss[below]


class BestSteps(StatefulProcessor):
    """Per run: the best loss and the last step so far, and a timer that forgets a run after ``idle`` without rows."""

    def __init__(self, idle_ms: int | None, timed: bool):
        self.idle_ms, self.timed = idle_ms, timed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "best DOUBLE, last BIGINT")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best, last = self.seen.get() if self.seen.exists() else (None, None)
        stairs = np.zeros(0, np.int64), np.zeros(0, np.float64)
        late, high, newest = 0, last, 0
        for part in rows:  # a run of any length: only its staircase is held
            part = part[part["step"].notna()]
            if not len(part):
                continue
            if self.timed:
                newest = max(newest, int(part["ts"].max().timestamp() * 1000))
            step = part["step"].to_numpy(np.int64)
            fresh = np.ones(len(step), bool) if last is None else step > last
            late += int((~fresh).sum())
            if fresh.any():
                top = int(step[fresh].max())
                high = top if high is None else max(high, top)
            judged = fresh & part["loss"].notna().to_numpy()
            loss = part["loss"].to_numpy(np.float64)
            stairs = staircase(np.concatenate([stairs[0], step[judged]]), np.concatenate([stairs[1], loss[judged]]))
        found = stairs[1] < best if best is not None else np.ones(len(stairs[1]), bool)
        if high is not None:
            lowest = [x for x in (best, float(stairs[1].min()) if len(stairs[1]) else None) if x is not None]
            self.seen.update((min(lowest) if lowest else None, high))
        if self.idle_ms is not None:
            self._rest(newest if self.timed else timerValues.getCurrentProcessingTimeInMs())
        n = int(found.sum())
        yield pd.DataFrame(
            {
                "run": [key[0]] * (n + 1),
                "step": pd.array([*stairs[0][found].tolist(), None], dtype="Int64"),
                "loss": [*stairs[1][found].tolist(), None],
                "out_of_order": pd.array([None] * n + [late], dtype="Int64"),
            }
        )

    def _rest(self, now: int) -> None:
        """One timer a run, at ``idle`` after its newest row."""
        due = now + self.idle_ms
        held = list(self.handle.listTimers())
        if held and max(held) >= due:
            return
        for t in held:
            self.handle.deleteTimer(t)
        self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter([])

    def close(self) -> None:
        pass


def run_stream_best(
    stream: DataFrame, *, run: str = "run", step: str = "step", loss: str = "loss", ts: str | None = None,
    late: str = LATE, idle: timedelta | None = None, base: str | None = None,
) -> DataFrame:
    """New-best steps (run, step, loss) of each run, as the steps arrive over the triggers.

    A step is a new best if its loss is strictly below every earlier step's. Within a trigger steps may come in any order; a step that comes
    in a later trigger than a higher step was judged in is not judged: ``out_of_order`` counts these. Null steps are left out, a null
    loss is never best but counts as a step. Per run the state store (RocksDB) holds one loss and one step, whatever the run's
    length; with ``idle`` a run without rows for so long is forgotten, by event time if ``ts`` is named (rows behind the watermark of ``late`` are
    then dropped), else by the clock; steps that come later start it anew.

    Checkpoint and results are kept under ``base``: a later call goes on where the last one ended. A trigger that is repeated after a
    failure overwrites its own results.
    """
    spark = stream.sparkSession
    checkpoint, out = _states(base or new_path(spark, "live-best"))
    columns = [F.col(run).alias("run"), F.col(step).cast("bigint").alias("step"), F.col(loss).cast("double").alias("loss")]
    slim = stream.select(*columns, F.col(ts).cast("timestamp").alias("ts")).withWatermark("ts", late) if ts else stream.select(*columns)
    mode = "None" if idle is None else "EventTime" if ts else "ProcessingTime"
    result = StructType([slim.schema["run"], *StructType.fromDDL("step BIGINT, loss DOUBLE, out_of_order BIGINT").fields])
    processor = BestSteps(None if idle is None else int(idle.total_seconds() * 1000), ts is not None)
    found = slim.groupBy("run").transformWithStateInPandas(processor, outputStructType=result, outputMode="Update", timeMode=mode)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/trigger={batch_id}")

    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)  # read when the query starts
    try:
        start = found.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        start.outputMode("update").foreachBatch(write).start().awaitTermination()
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)
    rows = _triggers(spark, out, result).filter("step IS NOT NULL")
    return rows.select(F.col("run").alias(run), F.col("step").alias(step), F.col("loss").alias(loss))


def out_of_order(spark: SparkSession, base: str, run_type: str = "STRING", run: str = "run") -> DataFrame:
    """Steps of each run that came too late to be judged by ``run_stream_best`` in ``base``."""
    schema = StructType([*StructType.fromDDL(f"run {run_type}").fields, StructField("out_of_order", LongType())])
    rows = _triggers(spark, _states(base)[1], schema)
    return rows.groupBy(F.col("run").alias(run)).agg(F.coalesce(F.sum("out_of_order"), F.lit(0)).alias("out_of_order"))


def live_state(spark: SparkSession, base: str) -> DataFrame:
    """(run, best, last): what the state store holds now for ``run_stream_best`` in ``base``, a row per run that is not forgotten."""
    reader = spark.read.format("statestore").option("stateVarName", "seen")
    return reader.load(_states(base)[0]).select("key.*", "value.*")
