"""The three stages end to end: tables in, tables out, a ledger in between.

Each stage reads its slice of the comparisons, writes its results under the
output folder and records itself when they are complete. A stage that is in the
ledger is skipped; the policy stage always runs. Only stage names and totals
reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import tokens as tk
from ..functions.chat import DEFAULT_TEMPLATE, chat_array
from ..operators import batches as bt, best, encode as enc, metrics, models, scoring, splits
from ..sources import ledger, manifests, runlog
from ..sources.comparisons import check_columns, complete_rows, quarantine


@dataclass(frozen=True)
class FlowConfig:
    """Settings of a run. Without a plan the stages share all training rows in the scaled proportions; without
    ``eval_rows`` the whole evaluation split is used; without ``step_cap`` no policy batch is left out of the statistics.
    The policy stage leaves a manifest after every ``save_every`` batches."""

    run: str = "run"
    plan: splits.StagePlan | None = None
    sft: bt.BatchPlan = bt.SFT_PLAN
    reward: bt.BatchPlan = bt.REWARD_PLAN
    policy: bt.BatchPlan = bt.POLICY_PLAN
    vocab_size: int = 50_000
    max_length: int = 1024
    eval_rows: int | None = None
    step_cap: int | None = None
    save_every: int = 100


@dataclass
class Flow:
    """``comparisons`` has idx (position in its split), split, prompt, chosen, rejected."""

    spark: SparkSession
    comparisons: DataFrame
    out: str
    config: FlowConfig = field(default_factory=FlowConfig)

    STAGES = ("sft", "reward", "policy")

    def path(self, name: str) -> str:
        return f"{self.out}/{name}"

    @property
    def train(self) -> DataFrame:
        return complete_rows(check_columns(self.comparisons)).filter("split = 'train'")

    @property
    def held_out(self) -> DataFrame:
        """The evaluation split, or its first ``eval_rows``; both fitting stages use it."""
        rows = complete_rows(self.comparisons).filter("split = 'valid1'")
        return rows if self.config.eval_rows is None else splits.head_n(rows, self.config.eval_rows)

    @cached_property
    def plan(self) -> splits.StagePlan:
        """The given plan, or one scaled to the training rows (positions from 0)."""
        if self.config.plan:
            return self.config.plan
        last = self.comparisons.filter("split = 'train'").agg(F.max("idx")).first()[0]
        return splits.StagePlan.scaled(0 if last is None else last + 1)

    def stage_rows(self, name: str) -> DataFrame:
        stage = next(s for s in self.plan.stages if s.name == name)
        return splits.slice_rows(self.train, stage.start, stage.end)

    def todo(self) -> list[str]:
        names = ",".join(f"('{self.config.run}', '{s}', {str(s == 'policy').lower()})" for s in self.STAGES)
        planned = self.spark.sql(f"SELECT * FROM VALUES {names} AS p(run, stage, always)")
        left = ledger.stage_todo(planned, ledger.read_ledger(self.spark, self.path("ledger"), run=self.config.run))
        waiting = {r["stage"] for r in left.collect()}
        return [s for s in self.STAGES if s in waiting]

    def run(self) -> list[str]:
        """Run what is left, in order; returns the stages that ran."""
        ran = self.todo()
        for name in ran:
            getattr(self, f"run_{name}")()
            ledger.record_stage(self.spark, self.path("ledger"), run=self.config.run, stage=name, output=self.path(name))
        return ran

    def run_sft(self) -> None:
        """Encoded chats, their batch plan, the language model counts and its evaluation loss."""
        rows, c = self.stage_rows("sft"), self.config
        text = DEFAULT_TEMPLATE.render(chat_array("prompt", "chosen"))
        tokens = tk.tokens(text, template=DEFAULT_TEMPLATE, newlines=True)
        counts = enc.token_counts(rows, tokens)
        vocab = enc.Vocabulary.stored(enc.build_vocab(counts, c.vocab_size))
        vocab.table.write.mode("overwrite").parquet(self.path("vocabulary"))
        coded = enc.encode(rows, vocab, key="idx", tokens=tokens).select(
            "idx", tk.truncate("input_ids", c.max_length).alias("input_ids"), tk.is_truncated("input_ids", c.max_length).alias("truncated")
        )
        coded.write.mode("overwrite").parquet(self.path("sft/encoded"))
        plan = bt.plan_batches(rows.select("idx").withColumnRenamed("idx", "row_id"), key="row_id", plan=c.sft)
        plan = plan.select(F.col("row_id").alias("idx"), "epoch", "batch_id", "pos")
        plan.write.mode("overwrite").partitionBy("epoch").parquet(self.path("sft/batches"))
        model = models.lm_fit(rows, key="idx", text="chosen")
        model.bigrams.write.mode("overwrite").parquet(self.path("sft/bigrams"))
        scored = models.text_nll(self.held_out, {"nll": model}, key="idx", text="chosen")
        found = metrics.eval_loss(bt.batch_ids(scored, c.sft.batch_size), batch=["batch_id"], loss="nll", tokens="n_tokens")
        steps = c.sft.epochs * c.sft.steps_per_epoch(rows.count())
        found = found.select(F.lit(c.run).alias("run"), F.lit(steps).alias("step"), F.col("eval_loss").alias("loss"))
        runlog.replace_log(runlog.metrics_long(found, stage="eval", metrics=["loss"]), self.path("log"))

    def sft_batches(self, epoch: int) -> DataFrame:
        """Padded and stacked batches of one epoch, put together from keys and ids."""
        plan = self.spark.read.parquet(self.path("sft/batches")).filter(F.col("epoch") == epoch)
        rows = plan.join(self.spark.read.parquet(self.path("sft/encoded")), "idx")
        padded = enc.pad_batch(rows, batch=["epoch", "batch_id"])
        labelled = padded.withColumn("labels", tk.causal_labels("input_ids"))
        return enc.stack_batch(labelled, columns=("input_ids", "attention_mask", "labels"))

    def pair_features(self, rows: DataFrame) -> DataFrame:
        return rows.select(
            "idx",
            models.text_features("chosen").alias("chosen_feature"),
            models.text_features("rejected").alias("rejected_feature"),
        )

    def run_reward(self) -> None:
        """The fitted reward head, its step metrics and its result on the held-out split."""
        rows, c = self.pair_features(self.stage_rows("reward")), self.config
        rows.write.mode("overwrite").parquet(self.path("reward/features"))
        rows = self.spark.read.parquet(self.path("reward/features"))
        model = models.reward_fit(rows)
        model.write().overwrite().save(self.path("reward/model"))
        weights = models.head_weights(model)
        scored = self.scored_pairs(rows, weights)
        planned = bt.plan_batches(scored.withColumnRenamed("idx", "row_id"), key="row_id", plan=c.reward)
        steps = metrics.step_pair_metrics(planned, accumulation=c.reward.accumulation, by=["epoch"])
        steps = bt.global_step(steps, steps_per_epoch=c.reward.steps_per_epoch(rows.count()))
        names = ["loss", "accuracy", "chosen_reward_mean", "rejected_reward_mean"]
        logged = steps.select(F.lit(c.run).alias("run"), F.col("global_step").alias("step"), *names)
        runlog.replace_log(runlog.metrics_long(logged, stage="reward", metrics=names), self.path("log"))
        evaluated = metrics.pair_metrics(self.scored_pairs(self.pair_features(self.held_out), weights))
        evaluated.write.mode("overwrite").parquet(self.path("reward/eval"))
        fields = {"model_type": "reward_head", "base_model_path": self.path("sft"), "hidden_size": len(weights)}
        one = self.spark.sql(f"SELECT '{c.run}' AS run")
        manifests.write_manifests(manifests.run_manifest(one, keep=["run"], fields={"run": F.col("run"), **fields}), self.path("reward/manifest"))

    @staticmethod
    def scored_pairs(features: DataFrame, weights: list[float]) -> DataFrame:
        return features.select(
            "idx",
            scoring.reward_score("chosen_feature", weights).alias("chosen_score"),
            scoring.reward_score("rejected_feature", weights).alias("rejected_score"),
        )

    def run_policy(self) -> None:
        """Both answers of each prompt scored, the better one kept, batch stats and report."""
        c = self.config
        weights = models.head_weights(LogisticRegressionModel.load(self.path("reward/model")))
        answers = F.array(
            F.struct(F.lit(0).alias("cand_id"), F.col("chosen").alias("response")),
            F.struct(F.lit(1).alias("cand_id"), F.col("rejected").alias("response")),
        )
        rows = self.stage_rows("policy").select(F.col("idx").alias("prompt_id"), F.explode(answers).alias("a")).select("prompt_id", "a.*")
        score = scoring.reward_score(models.text_features("response"), weights)
        rewarded = scoring.reward_default(rows.withColumn("score", score)).drop("score", "defaulted")
        best.best_of_n(rewarded).write.mode("overwrite").parquet(self.path("policy/selected"))
        kept = self.spark.read.parquet(self.path("policy/selected"))
        first = next(s.start for s in self.plan.stages if s.name == "policy")
        placed = kept.withColumn("at", F.col("prompt_id") - first)
        placed = bt.batch_ids(placed, c.policy.batch_size, idx="at", rows=kept.count(), drop_last=c.policy.drop_last)
        stats = metrics.batch_reward_stats(placed if c.step_cap is None else bt.step_cap(placed, c.step_cap))
        stats.write.mode("overwrite").parquet(self.path("policy/stats"))
        stats = self.spark.read.parquet(self.path("policy/stats")).withColumn("run", F.lit(c.run))
        names = ["reward_mean", "reward_std", "reward_min", "reward_max"]
        runlog.replace_log(runlog.metrics_long(stats, stage="ppo", metrics=names, step="batch_id"), self.path("log"))
        log = stats.select("run", (F.col("batch_id") + 1).alias("step"), "reward_mean")
        states = manifests.checkpoint_states(log, value="reward_mean", every=c.save_every, higher_is_better=True)
        manifests.write_checkpoints(states, self.path("policy/checkpoints"), settings={"base_sft_model": self.base_path(), "reward_model": self.path("reward/model")})
        last = F.max_by(F.struct("reward_mean", "reward_std"), "batch_id")
        totals = stats.groupBy("run").agg(
            F.count(F.lit(1)).alias("total_steps"), F.min("reward_min").alias("reward_min"), F.max("reward_max").alias("reward_max"), last.alias("f")
        ).select("run", "total_steps", "reward_min", "reward_max", "f.*")
        totals = totals.withColumns({"base_model": self.base_path(), "reward_model": F.lit(self.path("reward/model")), "model": F.lit(self.path("policy"))})
        manifests.write_report(manifests.run_report(totals, plan=self.plan), self.path("policy/report"))
        fields = {
            "run": F.col("run"), "model_type": "ppo_final", "total_steps": F.col("total_steps"),
            "final_reward_mean": F.col("reward_mean"), "final_reward_std": F.col("reward_std"),
            "reward_range": {"reward_min": F.col("reward_min"), "reward_max": F.col("reward_max")},
            "base_sft_model": F.col("base_model"), "reward_model": F.col("reward_model"), "total_epochs": c.policy.epochs,
            "training_config": manifests.POLICY_SETTINGS | {"batch_size": c.policy.batch_size}, "data_splits": manifests.plan_ranges(self.plan),
        }
        manifests.write_manifests(manifests.run_manifest(totals, keep=["run"], fields=fields), self.path("policy/manifest"))

    def base_path(self) -> Column:
        """The base model's path as the reward stage's manifest gives it, with its default."""
        written = self.spark.read.text(self.path("reward/manifest")).limit(1).withColumnRenamed("value", "manifest")
        found = written.select(manifests.manifest_field("manifest", "base_model_path", "STRING", self.path("sft")).alias("p")).first()
        return F.lit(found["p"] if found else self.path("sft"))

    def reports(self) -> dict[str, DataFrame]:
        """Audits over the whole table: stage ranges with gaps, leaked texts, rejected
        rows, and evaluation rows that more than one stage reads."""
        readers = F.explode(F.array(F.lit("sft"), F.lit("reward")))
        staged = self.train.withColumn("stage", self.plan.label("idx", with_gaps=True))
        hashed = splits.hash_texts(staged.select("idx", "stage", "prompt", "chosen"))
        return {
            "splits": splits.split_report(self.train, self.plan),
            "leakage": splits.leakage_audit(hashed),
            "quarantine": quarantine(self.comparisons),
            "eval_reuse": splits.overlapping_rows(self.held_out.select("idx", readers.alias("stage"))),
        }
