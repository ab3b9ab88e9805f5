"""Best checkpoints: running minima, overall minima and best answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import idiv

BLOCK = 4096


def prior_min(
    df: DataFrame, *, run: Sequence[str], step: str, value: str, out: str = "prior_min", block: int = BLOCK, levels: int = 2
) -> DataFrame:
    """Least ``value`` of all earlier steps of the run (NULL at the first).

    A run may hold most of the table, so it is cut into blocks of ``block`` step
    numbers: minima run inside a block, and the blocks' own minima run one level
    up, where there is one row per block. After ``levels`` levels a window over
    the run sees at most steps / block^levels rows.
    """
    run = list(run)
    if levels == 0:
        w = Window.partitionBy(*run).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out, F.min(value).over(w))
    at, least, inside, carried = (f"__{n}{levels}" for n in ("block", "least", "inside", "carried"))
    blocked = df.withColumn(at, idiv(step, block))
    within = Window.partitionBy(*run, at).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    minima = blocked.groupBy(*run, at).agg(F.min(value).alias(least))
    above = prior_min(minima, run=run, step=at, value=least, out=carried, block=block, levels=levels - 1)
    return (
        blocked.withColumn(inside, F.min(value).over(within))
        .join(above.select(*run, at, carried), [*run, at], "left")
        .withColumn(out, F.least(inside, carried))
        .drop(at, inside, carried)
    )


def best_so_far(df: DataFrame, *, run: Sequence[str] = ("run",), step: str = "step", loss: str = "eval_loss", out: str = "is_best") -> DataFrame:
    """Flag steps whose loss is strictly below every earlier one (the first is)."""
    seen = prior_min(df, run=run, step=step, value=loss, out="__prior")
    better = F.col(loss).isNotNull() & (F.col("__prior").isNull() | (F.col(loss) < F.col("__prior")))
    return seen.withColumn(out, better).drop("__prior")


def best_checkpoint(df: DataFrame, *, run: Sequence[str] = ("run",), step: str = "step", loss: str = "eval_loss") -> DataFrame:
    """Step with the least loss per run; the earliest on a tie."""
    scored = df.filter(F.col(loss).isNotNull())
    return (
        scored.groupBy(*run)
        .agg(F.min(F.struct(F.col(loss).alias("l"), F.col(step).alias("s"))).alias("__best"))
        .select(*run, F.col("__best.s").alias("best_step"), F.col("__best.l").alias("best_loss"))
    )


def best_of_n(df: DataFrame, *, prompt: str = "prompt_id", candidate: str = "cand_id", response: str = "response", reward: str = "reward") -> DataFrame:
    """The response with the highest reward per prompt; the lowest candidate id on a tie."""
    order = F.struct(F.col(reward).alias("r"), (-F.col(candidate)).alias("c"))
    best = F.max_by(F.struct(candidate, response, reward), order)
    return (
        df.groupBy(prompt)
        .agg(F.count(F.lit(1)).alias("n_candidates"), best.alias("__b"))
        .select(prompt, "n_candidates", f"__b.{candidate}", f"__b.{response}", f"__b.{reward}")
    )
