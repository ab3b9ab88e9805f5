"""Streams: late rows counted, windows agree between modes, keyed state over restarts."""

import random
from datetime import timedelta

import numpy as np
from pyspark.sql import functions as F

from pairloom.operators.best import best_so_far
from pairloom.streaming import best as live_best, live

EVENT = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def arrive(spark, folder, rows):
    """One file; files are read in the order in which they were written."""
    made = spark.createDataFrame([(i, ts, 1, kind, float(i), "") for i, ts, kind in rows], "event_id BIGINT, ts STRING, user_id BIGINT, event_type STRING, value DOUBLE, props STRING")
    made.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(folder)


def test_late_rows_are_counted_per_trigger(spark, tmp_path):
    folder, base = str(tmp_path / "e"), str(tmp_path / "live")
    arrive(spark, folder, [(1, "2024-01-01 10:00:00", "a"), (2, "2024-01-01 11:00:00", "b")])
    arrive(spark, folder, [(3, "2024-01-10 10:00:00", "a")])
    arrive(spark, folder, [(4, "2024-01-01 12:00:00", "a"), (5, "2024-01-11 10:00:00", "a")])  # the mark still stands where the first file put it
    arrive(spark, folder, [(k, "2024-01-01 13:00:00", "a") for k in range(6, 10)] + [(10, "2024-01-08 00:00:00", "b"), (11, "2024-01-12 00:00:00", "b")])
    arrive(spark, folder, [(12, "2024-01-02 00:00:00", "b")])

    def drain(mode):
        return live.run_stream_metrics(live.read_events(spark, folder, pattern="*.parquet"), window="1 day", late="1 day", mode=mode, base=base)

    updated = drain("update")
    got = {r.trigger: (r.input_rows, r.accepted_rows, r.late_rows) for r in live.late_rows(spark, base).filter("input_rows > 0").collect()}
    assert [got[t] for t in sorted(got)] == [(2, 2, 0), (1, 1, 0), (2, 2, 0), (6, 1, 5), (1, 0, 1)]
    windows = {(r.window_start.day, r.event_type): r.n_rows for r in updated.collect()}
    assert windows == {(1, "a"): 2, (1, "b"): 1, (10, "a"): 1, (11, "a"): 1, (12, "b"): 1}

    closed = {(r.window_start.day, r.event_type): r.n_rows for r in drain("append").collect()}  # no new data: what is stored
    assert closed == {k: n for k, n in windows.items() if k[0] <= 10}
    assert live.late_rows(spark, base).agg(F.sum("late_rows")).first()[0] == 6
    arrive(spark, folder, [(13, "2024-01-01 00:00:00", "a"), (14, "2024-01-20 00:00:00", "a")])
    drain("update")
    assert live.late_rows(spark, base).agg(F.sum("late_rows")).first()[0] == 7


def test_late_rows_of_nothing(spark, tmp_path):
    assert live.late_rows(spark, str(tmp_path / "none")).count() == 0


def test_staircase_is_the_strict_running_minimum():
    rnd = np.random.default_rng(4)
    for n in (0, 1, 50):
        step, loss = rnd.permutation(n), rnd.integers(0, 12, n).astype(float)
        got = list(zip(*(x.tolist() for x in live_best.staircase(step, loss))))
        seen, want = [], []
        for s, x in sorted(zip(step.tolist(), loss.tolist())):
            if not seen or x < min(seen):
                want.append((s, x))
            seen.append(x)
        assert got == want


def steps_stream(spark, folder):
    return spark.readStream.schema("run STRING, step BIGINT, loss DOUBLE, ts TIMESTAMP, extra STRING").option("maxFilesPerTrigger", 1).parquet(folder)


def log(spark, folder, rows):
    made = spark.createDataFrame([(*r, "x") for r in rows], "run STRING, step BIGINT, loss DOUBLE, ts STRING, extra STRING")
    made.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(folder)


def test_best_steps_equal_the_batch_operator(spark, tmp_path):
    """Shuffled inside each trigger, in order over triggers, one long run; state of one row a run."""
    rnd, folder, base = random.Random(7), str(tmp_path / "e"), str(tmp_path / "live")
    rows = [(rnd.choice("aaab"), s, rnd.choice([None, float("inf")]) if s % 31 == 0 else round(1000 / (s + 1) + rnd.random() * 50, 3), "2024-01-01") for s in range(900)]
    for a, b in ((0, 250), (250, 251), (251, 700), (700, 900)):
        log(spark, folder, rnd.sample(rows[a:b], b - a))
        got = {(r.run, r.step, r.loss) for r in live_best.run_stream_best(steps_stream(spark, folder), base=base).collect()}
    whole = spark.createDataFrame([r[:3] for r in rows], "run STRING, step BIGINT, loss DOUBLE")
    want = {(r.run, r.step, r.loss) for r in best_so_far(whole, loss="loss").filter("is_best").collect()}
    assert got == want
    state = {r.run: (r.best, r["last"]) for r in live_best.live_state(spark, base).collect()}
    assert state == {run: (min(r[2] for r in rows if r[0] == run and r[2] is not None), max(r[1] for r in rows if r[0] == run)) for run in "ab"}
    assert {r.run: r.out_of_order for r in live_best.out_of_order(spark, base).collect()} == {"a": 0, "b": 0}


def test_null_steps_and_losses(spark, tmp_path):
    folder, base = str(tmp_path / "e"), str(tmp_path / "live")
    log(spark, folder, [("a", None, 1.0, None), ("a", 5, None, None), ("b", None, None, None), (None, 1, 2.0, None)])
    log(spark, folder, [("a", 4, 1.0, None), ("a", 6, 9.0, None), ("b", 1, 3.0, None), (None, 2, 1.0, None)])
    got = live_best.run_stream_best(steps_stream(spark, folder), base=base)
    assert sorted(((r.run, r.step, r.loss) for r in got.collect()), key=str) == [("a", 6, 9.0), ("b", 1, 3.0), (None, 1, 2.0), (None, 2, 1.0)]
    assert {r.run: r.out_of_order for r in live_best.out_of_order(spark, base).collect()} == {"a": 1, "b": 0, None: 0}


def test_dead_runs_are_forgotten(spark, tmp_path):
    folder, base = str(tmp_path / "e"), str(tmp_path / "live")

    def drain():
        out = live_best.run_stream_best(steps_stream(spark, folder), ts="ts", late="1 hour", idle=timedelta(days=1), base=base)
        return sorted((r.run, r.step) for r in out.collect()), {r.run for r in live_best.live_state(spark, base).collect()}

    log(spark, folder, [("dead", 1, 1.0, "2024-01-01 00:00:00"), ("live", 1, 5.0, "2024-01-01 00:00:00")])
    assert drain() == ([("dead", 1), ("live", 1)], {"dead", "live"})
    log(spark, folder, [("live", 2, 6.0, "2024-01-01 20:00:00")])
    assert drain()[1] == {"dead", "live"}
    log(spark, folder, [("live", 3, 4.0, "2024-01-02 12:00:00")])
    assert drain() == ([("dead", 1), ("live", 1), ("live", 3)], {"live"})
    log(spark, folder, [("dead", 2, 7.0, "2024-01-02 12:30:00"), ("live", 4, 4.5, "2024-01-02 12:30:00")])
    assert drain() == ([("dead", 1), ("dead", 2), ("live", 1), ("live", 3)], {"dead", "live"})  # a run that comes back starts anew
