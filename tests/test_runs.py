"""Batch plans, losses, sampling, models, side files and streams."""

import dataclasses
import json
import math
from pathlib import Path

import pytest
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import functions as F

from pairloom import session
from pairloom.functions.numeric import pair_loss
from pairloom.operators import batches as bt, metrics, models, sampling, scoring
from pairloom.operators.splits import Stage, StagePlan
from pairloom.plans import inputs
from pairloom.plans.catalog import QUERIES
from pairloom.plans.flow import Flow, FlowConfig
from pairloom.sources import ledger, manifests, runlog
from pairloom.streaming import best as live_best, live

SF = "/root/testdata/sf0.001"


def test_workload_arithmetic():
    assert bt.SFT_PLAN.batches(10000) == 2500 and bt.SFT_PLAN.steps_per_epoch(10000) == 104
    assert bt.SFT_PLAN.planned_steps(10000) == 312 and bt.SFT_PLAN.effective_batch == 96
    assert bt.REWARD_PLAN.steps_per_epoch(10000) == 78 and bt.REWARD_PLAN.effective_batch == 128
    assert bt.POLICY_PLAN.batches(5000) == 625 and bt.POLICY_STEP_CAP * bt.POLICY_PLAN.batch_size == 4000


def test_groups_steps_and_tail(spark):
    planned = bt.plan_batches(spark.range(10000).withColumnRenamed("id", "k"), key="k", plan=bt.SFT_PLAN)
    groups = bt.accum_groups(bt.batches_of(planned), bt.SFT_PLAN.accumulation)
    steps = bt.global_step(groups, steps_per_epoch=104)
    r = steps.agg(F.count("*").alias("n"), F.min("global_step").alias("a"), F.max("global_step").alias("b"), F.max("batch_id").alias("m")).first()
    assert (r.n, r.a, r.b, r.m) == (3 * 104 * 24, 1, 312, 104 * 24 - 1)
    due = bt.cadence(steps.select("global_step").distinct(), every={"evals": 50, "saves": 200})
    r = due.agg(F.sum(F.col("evals").cast("int")).alias("e"), F.sum(F.col("saves").cast("int")).alias("s")).first()
    assert (r.e, r.s) == (6, 1)


def test_policy_checkpoints_skip_zero(spark):
    batches = bt.step_cap(spark.range(625).withColumnRenamed("id", "batch_id"))
    due = bt.cadence(batches, step="batch_id", every={"save": 100}, skip_zero=["save"]).filter("save")
    assert sorted(r.batch_id for r in due.collect()) == [100, 200, 300, 400]


def test_drop_last(spark):
    df = spark.range(10).withColumnRenamed("id", "idx")
    assert bt.batch_ids(df, 4).select("batch_id").distinct().count() == 3
    assert bt.batch_ids(df, 4, rows=10, drop_last=True).count() == 8


def pairs(spark, rows):
    return spark.createDataFrame(rows, "batch_id BIGINT, chosen_score DOUBLE, rejected_score DOUBLE")


def test_zero_head_loss_is_ln2(spark):
    r = metrics.pair_metrics(pairs(spark, [(0, 0.0, 0.0), (0, 0.0, 0.0)])).first()
    assert r.loss == pytest.approx(math.log(2)) and r.accuracy == 0.0


def test_loss_is_finite_for_wide_gaps(spark):
    rows = pairs(spark, [(0, -400.0, 400.0), (0, 400.0, -400.0)]).select(pair_loss("chosen_score", "rejected_score").alias("l")).collect()
    assert rows[0].l == pytest.approx(800.0) and rows[1].l == 0.0


def test_step_metrics_scopes(spark):
    df = pairs(spark, [(0, 1.0, 0.0), (1, 0.0, 1.0), (2, 1.0, 0.0)])
    last = metrics.step_pair_metrics(df, accumulation=2).collect()
    group = metrics.step_pair_metrics(df, accumulation=2, scope="group").collect()
    assert len(last) == len(group) == 1
    assert last[0].accuracy == 0.0 and group[0].accuracy == 0.5
    assert last[0].loss == pytest.approx((math.log1p(math.e**-1) + math.log1p(math.e)) / 2) == group[0].loss


def test_unscored_pairs_do_not_break_a_step(spark):
    df = pairs(spark, [(0, None, 1.0), (1, None, None), (2, 1.0, 0.0), (3, 2.0, None)])
    first, second = metrics.step_pair_metrics(df, accumulation=2).orderBy("accum_group").collect()
    assert (first.loss, first.accuracy, first.chosen_reward_mean) == (None, None, None)
    assert (second.accuracy, second.chosen_reward_mean) == (None, 2.0) and second.loss is not None


def test_eval_loss_is_the_mean_of_batch_means(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 10.0)], "b BIGINT, loss DOUBLE")
    assert metrics.eval_loss(df, batch=["b"]).first()["eval_loss"] == 6.0
    assert metrics.eval_loss(df.filter("b > 5"), batch=["b"]).first()["eval_loss"] == 0.0


def test_batch_of_one_has_no_deviation(spark):
    df = spark.createDataFrame([(0, 1.0)], "batch_id BIGINT, reward DOUBLE")
    assert metrics.batch_reward_stats(df).first()["reward_std"] is None


def test_merge_last_layer_wins_even_with_null(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0)], "step BIGINT, name STRING, value DOUBLE")
    b = spark.createDataFrame([(1, "x", None), (1, "z", 3.0)], "step BIGINT, name STRING, value DOUBLE")
    got = {r["name"]: r["value"] for r in metrics.metric_merge([a, b], key=["step"]).collect()}
    assert got == {"x": None, "y": 2.0, "z": 3.0}


def test_formats(spark):
    df = spark.createDataFrame([(1234567, 0.00001, 0.12345)], "n BIGINT, lr DOUBLE, loss DOUBLE")
    r = metrics.metric_format(df, {"n": metrics.COUNT_FORMAT, "lr": metrics.RATE_FORMAT, "loss": metrics.LOSS_FORMAT}).first()
    assert (r.n, r.lr, r.loss) == ("1,234,567", "1.00e-05", "0.1235")


def test_last_token(spark):
    rows = [([[1.0], [2.0], [3.0]], [1, 1, 0]), ([[1.0]], [0]), ([], [])]
    df = spark.createDataFrame(rows, "s ARRAY<ARRAY<DOUBLE>>, m ARRAY<INT>")
    assert [r[0] for r in df.select(scoring.last_token("s", "m")).collect()] == [[2.0], None, None]
    assert [r[0] for r in df.select(scoring.last_token("s")).collect()] == [[3.0], [1.0], None]


def test_rewards_default_and_flag(spark):
    df = spark.createDataFrame([([1.0, 2.0],), (None,)], "f ARRAY<DOUBLE>").withColumn("score", scoring.reward_score("f", [0.5, 1.0], 1.0))
    assert [(r.reward, r.defaulted) for r in scoring.reward_default(df).collect()] == [(3.5, False), (0.0, True)]


def test_score_pairs_with_a_hot_item(spark):
    ids = spark.range(600).select(F.col("id").alias("idx"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("chosen_id"), (F.col("id") * 2).alias("rejected_id"))
    scores = spark.range(700).select(F.col("id").alias("k"), (F.col("id") / 2).alias("score"))
    got = scoring.score_pairs(ids, scores, key="k")
    want = scoring.score_pairs(ids, scores, key="k", unique=True).select(got.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == 600
    assert got.filter("rejected_score IS NULL").count() == got.filter("rejected_id >= 700").count() > 0


def test_nucleus_properties(spark):
    rows = [(p, c, float(c % 7)) for p in range(20) for c in range(p + 1)]
    df = spark.createDataFrame(rows, "prompt_id BIGINT, cand_id BIGINT, logit DOUBLE")
    config = sampling.SamplingConfig(top_k=5)
    kept = sampling.nucleus(df, config)
    sums = kept.groupBy("prompt_id").agg(F.sum("q").alias("s"), F.count("*").alias("n"), F.min("rank").alias("first")).collect()
    assert len(sums) == 20 and all(abs(r.s - 1) < 1e-9 and r.n <= 5 and r["first"] == 1 for r in sums)
    assert sampling.sample_candidates(df, config).count() == 20


def test_top_item_stays_when_it_outweighs_p(spark):
    df = spark.createDataFrame([(1, 1, 50.0), (1, 2, 0.0)], "prompt_id BIGINT, cand_id BIGINT, logit DOUBLE")
    assert [r.cand_id for r in sampling.nucleus(df).collect()] == [1]


def test_top_k_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("prompt_id"), F.col("id").alias("cand_id"), F.rand(1).alias("logit"))
    plan = sampling.sample_candidates(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[-1]


def test_reward_head_learns_and_reloads(spark, tmp_path):
    rows = [(i, [float(i % 5) + 1.0, 0.3], [float(i % 5) - 1.0, 0.3]) for i in range(60)]
    df = spark.createDataFrame(rows, "id BIGINT, chosen_feature ARRAY<DOUBLE>, rejected_feature ARRAY<DOUBLE>")
    model = models.reward_fit(df)
    weights = models.head_weights(model)
    assert weights[0] > 0 and abs(weights[1]) < 1e-6
    model.write().overwrite().save(str(tmp_path / "m"))
    assert models.head_weights(LogisticRegressionModel.load(str(tmp_path / "m"))) == weights
    assert Flow.scored_pairs(df.withColumn("idx", F.col("id")), weights).filter("chosen_score > rejected_score").count() == 60


@pytest.mark.parametrize("few", [True, False])
def test_bigram_model_by_hand(spark, few):
    fit = spark.createDataFrame([(1, "a b a b"), (2, "a c")], "id BIGINT, text STRING")
    model = dataclasses.replace(models.lm_fit(fit, key="id"), few_contexts=few)
    assert model.vocab_size == 3
    got = models.text_nll(spark.createDataFrame([(9, "a b"), (10, "z")], "id BIGINT, text STRING"), {"m": model}, key="id")
    nll = {r.id: r.m for r in got.collect()}
    assert nll[9] == pytest.approx(-math.log(3 / 5) - math.log(3 / 6)) and nll[10] == pytest.approx(-math.log(1 / 5))


def test_kl_flag(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0, 1.0), (1, 1.0, 1.05, 1.0)], "b BIGINT, policy DOUBLE, reference DOUBLE, r DOUBLE")
    got = {r.b: r for r in models.kl_watch(df, by=["b"], reward="r").collect()}
    assert got[0].over_target and not got[1].over_target and got[0].penalised_reward == pytest.approx(0.8)


def test_log_appends(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 0.5, None)], "run STRING, step BIGINT, loss DOUBLE, acc DOUBLE")
    for _ in range(2):
        runlog.append_log(runlog.metrics_long(df, stage="train", metrics=["loss", "acc"]), str(tmp_path / "log"))
    rows = runlog.read_log(spark, str(tmp_path / "log")).collect()
    assert len(rows) == 4 and {r["name"] for r in rows} == {"train/loss", "train/acc"}
    runlog.replace_log(runlog.metrics_long(df, stage="train", metrics=["loss"]), str(tmp_path / "log"))
    runlog.replace_log(runlog.metrics_long(df, stage="eval", metrics=["loss"]), str(tmp_path / "log"))
    assert runlog.read_log(spark, str(tmp_path / "log")).count() == 2


def test_manifest_defaults(spark):
    runs = spark.createDataFrame([("a",), ("b",), ("c",)], "run STRING")
    found = spark.createDataFrame([("a", '{"base":"x"}'), ("b", '{"other":1}')], "run STRING, manifest STRING")
    got = manifests.manifest_lookup(runs, found, key="run", name="base", ddl="STRING", default="sft")
    assert {r.run: r.base for r in got.collect()} == {"a": "x", "b": "sft", "c": "sft"}


def test_scoring_plans_stay_in_the_jvm(spark):
    for name in ("render_pairs", "rollout_rewards", "ranking_loss", "batch_reward_stats", "best_so_far", "lm_eval_loss"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan, name
        assert "SinglePartition" not in plan or "TakeOrdered" in plan, name
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def write_events(spark, folder, shuffle):
    events = spark.read.parquet(f"{SF}/events.parquet")
    (events.repartition(4) if shuffle else events.repartitionByRange(4, "ts")).write.parquet(folder)
    return events


@pytest.mark.parametrize("shuffle", [False, True])
def test_stream_complete_equals_batch(spark, tmp_path, shuffle):
    events = write_events(spark, str(tmp_path / "e"), shuffle)
    got = live.run_stream_metrics(live.read_events(spark, str(tmp_path / "e"), pattern="*.parquet"), window="1 day", mode="update", late="400 days")
    want = live.windowed_stats(events, window="1 day")
    keys = ["window_start", "event_type", "n_rows", "reward_min", "reward_max"]
    assert got.select(keys).exceptAll(want.select(keys)).count() == 0 and got.count() == want.count()


def test_stream_append_closes_windows_and_drops_late_rows(spark, tmp_path):
    days = [f"2024-01-0{d} 12:00:00" for d in (1, 2, 3, 4, 5)]
    rows = [(i, ts) for i, ts in enumerate([*days, "2024-01-01 13:00:00"])]
    for i, ts in rows:  # one file per row, read in this order
        spark.sql(f"SELECT {i}L AS event_id, TIMESTAMP_NTZ '{ts}' AS ts, 1L AS user_id, 'a' AS event_type, 1.0D AS value, '' AS props").coalesce(
            1
        ).write.mode("append").parquet(str(tmp_path / "e"))
    stream = live.read_events(spark, str(tmp_path / "e"), pattern="*.parquet")
    got = live.run_stream_metrics(stream, window="1 day", late="1 day", mode="append")
    counts = {r.window_start.day: r.n_rows for r in got.collect()}
    assert counts[1] == 1 and 5 not in counts


def test_stream_best_equals_batch_over_triggers(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    bounds = [0, 300, 301, 700, 10**9]
    for a, b in zip(bounds, bounds[1:]):
        events.filter(f"event_id >= {a} AND event_id < {b}").coalesce(1).write.mode("append").parquet(str(tmp_path / "e"))
    stream = live.read_events(spark, str(tmp_path / "e"), pattern="*.parquet")
    steps = stream.select(F.col("event_type").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("loss"))
    got = {(r.run, r.step) for r in live_best.run_stream_best(steps).collect()}
    best, want = {}, set()
    for r in sorted(events.collect(), key=lambda r: r.event_id):
        if r.value < best.get(r.event_type, math.inf):
            best[r.event_type] = r.value
            want.add((r.event_type, r.event_id))
    assert got == want


def test_flow_runs_skips_and_reports(spark, tmp_path):
    rows = inputs.pairs(spark, SF).rows.withColumn("idx", F.col("split_pos"))
    plan = StagePlan((Stage("sft", 0, 12), Stage("reward", 12, 22), Stage("policy", 24, 30)))
    config = FlowConfig(
        run="r1", plan=plan, sft=bt.BatchPlan(2, 2, 2), reward=bt.BatchPlan(2, 2, 1), policy=bt.BatchPlan(4, 1, 1), vocab_size=500, save_every=1
    )
    flow = Flow(spark, rows, str(tmp_path / "out"), config)
    assert flow.run() == ["sft", "reward", "policy"]
    logged = runlog.read_log(spark, flow.path("log")).count()
    assert flow.run() == ["policy"]
    assert runlog.read_log(spark, flow.path("log")).count() == logged
    stacked = flow.sft_batches(1).collect()
    assert len(stacked) == 6 and all(len({len(x) for x in r.input_ids}) == 1 for r in stacked)
    assert spark.read.parquet(flow.path("policy/selected")).count() == 6
    log = runlog.read_log(spark, flow.path("log"))
    assert {r.stage for r in log.select("stage").distinct().collect()} == {"eval", "reward", "ppo"}
    assert log.filter("name = 'eval/loss' AND step = 6 AND value > 0").count() == 1
    assert flow.reports()["eval_reuse"].count() == rows.filter("split = 'valid1'").count() == 3
    assert log.filter("name = 'reward/accuracy'").count() == 2
    manifest = json.loads(spark.read.text(flow.path("policy/manifest")).first()[0])
    saved = manifests.read_manifests(spark, flow.path("policy/checkpoints"), manifests.CHECKPOINT_SCHEMA).orderBy("epoch").collect()
    assert [(r.run, r.epoch, r.is_best, r.base_sft_model) for r in saved][0] == ("r1", 1, True, flow.path("sft")) and len(saved) == 2
    assert saved[1].best_loss == max(r.eval_loss for r in saved)
    assert manifest["total_steps"] == 2 and manifest["data_splits"]["policy_samples"] == "24-29"
    assert "Steps: 2" in "\n".join(r[0] for r in spark.read.text(flow.path("policy/report")).collect())
    assert {r.stage for r in flow.reports()["splits"].collect()} >= {"gap_before_policy", "unused"}
    assert flow.reports()["leakage"].count() == 0 and flow.reports()["quarantine"].count() == 0


def test_live_metrics_go_on_after_a_restart(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    folder, base = str(tmp_path / "e"), str(tmp_path / "live")

    def drain():
        return live.run_stream_metrics(live.read_events(spark, folder, pattern="*.parquet"), window="1 day", late="400 days", mode="update", base=base)

    keys = ["window_start", "event_type", "n_rows", "reward_min", "reward_max"]
    for part, seen in (("event_id < 400", "event_id < 400"), (None, "event_id < 400"), ("event_id >= 400", "true")):
        if part:
            events.filter(part).coalesce(1).write.mode("append").parquet(folder)
        got, want = drain().select(keys), live.windowed_stats(events.filter(seen), window="1 day").select(keys)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_live_best_goes_on_after_a_restart_and_counts_late_steps(spark, tmp_path):
    folder, base = str(tmp_path / "e"), str(tmp_path / "live")
    schema = "run STRING, step BIGINT, loss DOUBLE"

    def arrive(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        return sorted((r.run, r.step) for r in live_best.run_stream_best(stream, base=base).collect())

    assert arrive(("a", 1, 5.0), ("a", 2, 6.0), ("b", 1, 1.0)) == [("a", 1), ("b", 1)]
    assert arrive(("a", 4, 4.0), ("a", 5, 4.5), ("b", 2, 2.0)) == [("a", 1), ("a", 4), ("b", 1)]
    assert arrive(("a", 3, 1.0), ("a", 6, 3.0)) == [("a", 1), ("a", 4), ("a", 6), ("b", 1)]
    assert {r.run: r.out_of_order for r in live_best.out_of_order(spark, base).collect()} == {"a": 1, "b": 0}


def test_deleted_output_runs_again(spark, tmp_path):
    kept, gone, path = str(tmp_path / "kept"), str(tmp_path / "gone"), str(tmp_path / "ledger")
    spark.range(1).write.parquet(kept)
    ledger.record_stage(spark, path, run="r", stage="sft", output=kept)
    ledger.record_stage(spark, path, run="r", stage="reward", output=gone)
    assert [r.stage for r in ledger.read_ledger(spark, path, run="r").collect()] == ["sft"]


def test_batch_loss_weighs_tokens(spark):
    df = spark.createDataFrame([(0, 10.0, 10), (0, 30.0, 10), (1, 10.0, 2)], "b BIGINT, nll DOUBLE, n BIGINT")
    assert metrics.eval_loss(df, batch=["b"], loss="nll", tokens="n").first()["eval_loss"] == 3.5


def test_report_lists_stages_without_rows(spark):
    from pairloom.operators import splits

    report = {r.stage: r for r in splits.split_report(spark.range(22000).withColumnRenamed("id", "idx"), splits.DEFAULT_PLAN).collect()}
    assert report["policy"].n_rows == 0 and report["policy"].range is None and report["gap_before_policy"].n_rows == 2000


def test_slices_open_only_their_files(spark, tmp_path):
    rows = inputs.pairs(spark, "/root/testdata/sf0.01").rows
    path = str(tmp_path / "c")
    rows.repartitionByRange(8, "split", "split_pos").sortWithinPartitions("split", "split_pos").write.partitionBy("split").parquet(path)
    part = spark.read.parquet(path).filter("split = 'train' AND split_pos >= 10 AND split_pos < 20")
    used = {r.f for r in part.select(F.input_file_name().alias("f")).distinct().collect()}
    everything = spark.read.parquet(path).filter("split = 'train'").select(F.input_file_name().alias("f")).distinct().count()
    assert len(used) == 1 and everything > 3


def test_text_nll_shuffles_only_tokens_of_rare_pairs(spark, monkeypatch):
    """Frequent pairs are summed where they are read: no written table holds tokens of single texts."""
    texts = [(1, "a b a b a b"), (1, "b c"), (2, "a b z"), (None, "a b"), (3, ""), (4, None), (5, "c a b d")]
    df = spark.createDataFrame(texts, "id BIGINT, text STRING")
    model = models.lm_fit(df.filter("id < 3"), key="id")
    whole = {r.id: (r.n_tokens, round(r.m, 9)) for r in models.text_nll(df, {"m": model}, key="id").collect()}
    written = []
    monkeypatch.setattr(models, "store", lambda t, name, **k: (written.append((name, t.columns)), session.store(t, name, **k))[1])
    monkeypatch.setattr(models, "fits_broadcast", lambda t: False)
    monkeypatch.setattr(models, "HOT_PAIRS", 2)
    got = {r.id: (r.n_tokens, round(r.m, 9)) for r in models.text_nll(df, {"m": model}, key="id").collect()}
    assert got == whole and set(got) == {1, 2, 5, None} and got[1][0] == 8
    assert written and not [name for name, columns in written if "id" in columns]
    counts = {(r.prev, r.tok): r.n for r in model.bigrams.collect()}
    sums = {r.prev: r.n_prev for r in model.contexts.collect()}
    by_hand = -sum(math.log((counts.get(p, 0) + 1) / (sums.get(p[0], 0) + model.vocab_size)) for p in [("<s>", "c"), ("c", "a"), ("a", "b"), ("b", "d")])
    assert got[5] == (4, round(by_hand, 9))
    heavy = models._heaviest(spark.range(1, 1001).withColumn("weight", F.col("id")), 100)
    assert 50 < heavy.count() <= 100 and heavy.agg(F.min("id"), F.max("id")).first()[1] == 1000
    assert models._heaviest(spark.range(9).withColumn("weight", F.lit(5)), 3).count() == 0


def test_rounds_give_the_sums_of_one_and_delete_what_they_wrote(spark, monkeypatch):
    texts = [(i, " ".join(f"w{(i * k * k) % 23}" for k in range(i % 9))) for i in range(60)] + [(None, "w1 w2"), (3, "w1 w2 w1"), (4, None), (5, "")]
    df = spark.createDataFrame(texts, "id BIGINT, text STRING")
    folder = Path(session.shared_dir(spark).removeprefix("file://"), "pairloom")

    def run():
        there = set(folder.iterdir())
        both = {"a": models.lm_fit(df.filter("id < 40"), key="id"), "b": models.lm_fit(df.filter("id % 3 = 0"), key="id")}
        counts = sorted((tuple(r) for m in both.values() for r in m.bigrams.collect()), key=str)
        got = {r.id: (r.n_tokens, round(r.a, 9), round(r.b, 9)) for r in models.text_nll(df, both, key="id").collect()}
        return counts, got, {p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - there}

    counts, sums, _ = run()
    for name, value in (("ROUND_BYTES", 16), ("FIT_ROUNDS", 2), ("ROUNDS", 2), ("HOT_PAIRS", 40)):
        monkeypatch.setattr(models, name, value)
    for small in (True, False):
        monkeypatch.setattr(models, "fits_broadcast", lambda t, small=small: small)
        again = run()
        assert again[:2] == (counts, sums) and again[2] == {"bigrams", "contexts", "text-sums"}
