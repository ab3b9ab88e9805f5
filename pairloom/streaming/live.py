"""Run metrics watched while they arrive."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from ..session import new_path
from ..sources.ledger import path_exists

#: How late a row may be before its window is closed; bounds the state.
LATE = "30 days"
_STATS = ("n_rows", "reward_mean", "reward_std", "reward_min", "reward_max")

EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def read_events(spark: SparkSession, folder: str, *, pattern: str = "events.parquet", files_per_trigger: int = 1) -> DataFrame:
    """The metric stream, ``files_per_trigger`` new files at a time."""
    return (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("pathGlobFilter", pattern)
        .parquet(folder)
    )


def windowed_stats(
    stream: DataFrame, *, window: str, late: str | None = None, ts: str = "ts", key: str = "event_type", value: str = "value"
) -> DataFrame:
    """Reward stats per tumbling window and key; rows later than ``late`` are dropped.

    The state is one small aggregate per open window and key, combined before
    the shuffle, so a hot key costs one row per task.
    """
    # a watermark needs TIMESTAMP; windows alone work on either type
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late) if late else stream
    return (
        timed.groupBy(F.window(ts, window).alias("w"), key)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.avg(value).alias("reward_mean"),
            F.stddev_samp(value).alias("reward_std"),
            F.min(value).alias("reward_min"),
            F.max(value).alias("reward_max"),
        )
        .select(F.col("w.start").alias("window_start"), key, "n_rows", "reward_mean", "reward_std", "reward_min", "reward_max")
    )


def _states(base: str) -> tuple[str, str]:
    """Below one base folder: the stream's checkpoint and its outputs, so that one is never used without the other."""
    return f"{base}/checkpoint", f"{base}/out"


def _triggers(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """All rows written under ``trigger=N`` folders, with N; empty before the first trigger."""
    schema = StructType([*schema.fields, StructField("trigger", LongType())])
    if not path_exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def _progress_of(query: StreamingQuery, seen: dict[int, dict]) -> None:
    for p in query.recentProgress:
        p = p if isinstance(p, dict) else json.loads(p.json)
        seen[p["batchId"]] = p


def _write_progress(spark: SparkSession, out: str, progress: list[dict]) -> None:
    """Per trigger the rows that came in and the watermark that held, each in a folder of its own, so that repeats overwrite."""
    for p in progress:
        came = (p.get("observedMetrics") or {}).get("came") or {}
        row = [(came["n"] if isinstance(came, dict) else came[0]) if came else 0, (p.get("eventTime") or {}).get("watermark")]
        one = spark.createDataFrame([tuple(row)], "input_rows BIGINT, watermark STRING")
        typed = one.withColumn("watermark", F.to_timestamp("watermark"))
        typed.coalesce(1).write.mode("overwrite").parquet(f"{out}/progress/trigger={p['batchId']}")


_PROGRESS = StructType([StructField("input_rows", LongType()), StructField("watermark", TimestampType())])


def run_stream_metrics(stream: DataFrame, *, window: str, late: str = LATE, mode: str = "append", base: str | None = None) -> DataFrame:
    """Drain the stream and return the stats of all windows seen so far as a table.

    Every trigger writes the newest state of the windows it changed; the latest per window is returned: in ``update`` mode all of them, in
    ``append`` mode those that the watermark has closed. In both the watermark bounds the state and a row whose window is closed is
    dropped; ``late_rows`` counts these per trigger. Checkpoint and results are kept under ``base``: a later call with the same folder goes
    on where the last one ended and returns the results of both; without new data it returns what is stored.
    """
    spark = stream.sparkSession
    checkpoint, out = _states(base or new_path(spark, "live-metrics"))
    if mode not in ("append", "update"):
        raise ValueError(f"unknown mode {mode!r}")
    # what comes in is counted before the watermark drops anything
    stats = windowed_stats(stream.observe("came", F.count(F.lit(1)).alias("n")), window=window, late=late)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/windows/trigger={batch_id}")

    start = stats.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = start.outputMode("update").foreachBatch(write).start()
    seen: dict[int, dict] = {}
    written: set[int] = set()
    done = False
    while not done:
        done = query.awaitTermination(0.5)
        _progress_of(query, seen)
        new = sorted(set(seen) - written)
        _write_progress(spark, out, [seen[b] for b in new])
        written.update(new)
    rows = _triggers(spark, f"{out}/windows", stats.schema)
    key = [c for c in stats.columns if c not in _STATS]
    latest = rows.groupBy(*key).agg(F.max_by(F.struct(*_STATS), "trigger").alias("s")).select(*key, "s.*").select(*stats.columns)
    if mode == "update":
        return latest
    mark = _triggers(spark, f"{out}/progress", _PROGRESS).agg(F.max("watermark").alias("mark")).first()["mark"]
    # a window whose end is at the watermark is closed: rows at the mark itself belong to the next one
    end = F.col("window_start").cast("timestamp") + F.expr(f"INTERVAL {window}")
    return latest.filter(end <= F.lit(mark)) if mark is not None else latest.limit(0)


def late_rows(spark: SparkSession, base: str, *, window_key: tuple[str, ...] = ("window_start", "event_type")) -> DataFrame:
    """(trigger, input_rows, accepted_rows, late_rows, watermark) of ``run_stream_metrics`` in ``base``: per trigger, how many rows came behind the watermark.

    A row was accepted if its window's count grew by it, so late rows are those that came in and are in no window. A trigger whose progress
    was lost with its driver has null counts. The tables hold one row per trigger and changed window.
    """
    _, out = _states(base)
    fields = [StructField(c, spark.read.parquet(f"{out}/windows").schema[c].dataType) for c in window_key] if path_exists(spark, f"{out}/windows") else [StructField(c, LongType()) for c in window_key]
    counts = _triggers(spark, f"{out}/windows", StructType([*fields, StructField("n_rows", LongType())]))
    before = Window.partitionBy(*window_key).orderBy("trigger")
    grown = counts.withColumn("__new", F.col("n_rows") - F.coalesce(F.lag("n_rows").over(before), F.lit(0)))
    accepted = grown.groupBy("trigger").agg(F.sum("__new").alias("accepted_rows"))
    known = _triggers(spark, f"{out}/progress", _PROGRESS).join(accepted, "trigger", "full")
    taken = F.coalesce("accepted_rows", F.lit(0).cast("bigint"))
    return known.select("trigger", "input_rows", taken.alias("accepted_rows"), (F.col("input_rows") - taken).alias("late_rows"), "watermark")
