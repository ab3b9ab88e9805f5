"""Batch plans: epochs, order, batches, accumulation groups and cadence."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import idiv
from .rowindex import hash_order_index, row_index


@dataclass(frozen=True)
class BatchPlan:
    """Workload settings of a stage."""

    batch_size: int
    accumulation: int
    epochs: int
    seed: int = 42
    drop_last: bool = False

    @property
    def effective_batch(self) -> int:
        return self.batch_size * self.accumulation

    def batches(self, rows: int) -> int:
        full, rest = divmod(rows, self.batch_size)
        return full + (1 if rest and not self.drop_last else 0)

    def steps_per_epoch(self, rows: int) -> int:
        return self.batches(rows) // self.accumulation

    def planned_steps(self, rows: int) -> int:
        """The announced total: epochs * batches // accumulation (tails of epochs included)."""
        return self.epochs * self.batches(rows) // self.accumulation


# Workloads of the three stages.
SFT_PLAN = BatchPlan(batch_size=4, accumulation=24, epochs=3)
REWARD_PLAN = BatchPlan(batch_size=8, accumulation=16, epochs=1)
POLICY_PLAN = BatchPlan(batch_size=8, accumulation=1, epochs=1, drop_last=True)
POLICY_STEP_CAP = 500


def epoch_expand(keys: DataFrame, epochs: int) -> DataFrame:
    """Each key once per epoch. Pass keys only; wide columns are joined after batching."""
    return keys.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))


def epoch_shuffle(df: DataFrame, *, key: str, seed: int = 42, name: str = "idx") -> DataFrame:
    """A seeded order per epoch that does not depend on how the table is partitioned."""
    return hash_order_index(df, key, seed=seed, within=("epoch",), name=name)


def eval_order(df: DataFrame, *, key: Sequence[str], name: str = "idx") -> DataFrame:
    """Sequential order by key."""
    return row_index(df, list(key), name=name)


def batch_ids(df: DataFrame, batch_size: int, *, idx: str = "idx", rows: int | None = None, drop_last: bool = False) -> DataFrame:
    """Batch number and place in the batch; ``drop_last`` needs the rows per epoch."""
    out = df.withColumn("batch_id", idiv(idx, batch_size)).withColumn("pos", F.col(idx) % batch_size)
    if drop_last:
        if rows is None:
            raise ValueError("drop_last needs the number of rows per epoch")
        out = out.filter(F.col("batch_id") < rows // batch_size)
    return out


def plan_batches(keys: DataFrame, *, key: str, plan: BatchPlan, rows: int | None = None) -> DataFrame:
    """Keys to (epoch, idx, batch_id, pos) under ``plan``."""
    ordered = epoch_shuffle(epoch_expand(keys, plan.epochs), key=key, seed=plan.seed)
    return batch_ids(ordered, plan.batch_size, rows=rows, drop_last=plan.drop_last)


def batches_of(df: DataFrame, *, by: Sequence[str] = ("epoch",)) -> DataFrame:
    """One row per batch with its number of rows."""
    return df.groupBy(*by, "batch_id").agg(F.count(F.lit(1)).alias("n_rows"))


def accum_groups(batches: DataFrame, accumulation: int, *, by: Sequence[str] = ("epoch",)) -> DataFrame:
    """Accumulation group of each batch; groups cut short by the end of an epoch are dropped.

    A group is complete when it holds ``accumulation`` batches, so the count runs
    over one group and not over the epoch.
    """
    w = Window.partitionBy(*by, "accum_group")
    return (
        batches.withColumn("accum_group", idiv("batch_id", accumulation))
        .withColumn("__n", F.count(F.lit(1)).over(w))
        .filter(F.col("__n") == accumulation)
        .drop("__n")
    )


def global_step(df: DataFrame, *, steps_per_epoch: int) -> DataFrame:
    """Step number across epochs, in closed form."""
    return df.withColumn("global_step", F.col("epoch") * steps_per_epoch + F.col("accum_group") + 1)


def epoch_progress(df: DataFrame, *, batches_per_epoch: int, accumulation: int) -> DataFrame:
    """Fractional epoch at the batch that makes the step."""
    done = (F.col("accum_group") + 1) * accumulation
    return df.withColumn("epoch_progress", F.col("epoch") + done / F.lit(float(batches_per_epoch)))


def cadence(df: DataFrame, *, step: str = "global_step", every: dict[str, int], skip_zero: Sequence[str] = ()) -> DataFrame:
    """One flag column per event; those in ``skip_zero`` never fire at step 0."""
    for name, n in every.items():
        due = F.col(step) % n == 0
        if name in skip_zero:
            due = due & (F.col(step) > 0)
        df = df.withColumn(name, due)
    return df


def step_cap(df: DataFrame, cap: int = POLICY_STEP_CAP, *, batch: str = "batch_id") -> DataFrame:
    return df.filter(F.col(batch) < cap)


def step_plan(df: DataFrame, plan: BatchPlan, *, by: Sequence[str] = ()) -> DataFrame:
    """Rows, batches, steps taken and steps announced (one row, or one per group ``by``)."""
    rounding = 0 if plan.drop_last else plan.batch_size - 1
    return (
        df.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("batches", idiv(F.col("n_rows") + rounding, plan.batch_size))
        .withColumn("steps_per_epoch", idiv("batches", plan.accumulation))
        .withColumn("steps", F.col("steps_per_epoch") * plan.epochs)
        .withColumn("planned_steps", idiv(F.col("batches") * plan.epochs, plan.accumulation))
        .withColumn("unused_batches", F.col("batches") - F.col("steps_per_epoch") * plan.accumulation)
        .withColumn("effective_batch", F.lit(plan.effective_batch).cast("bigint"))
    )
