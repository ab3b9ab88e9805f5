"""Losses, run metrics and their merging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.chat import PREVIEW_CHARS, preview
from ..functions.numeric import idiv, pair_loss, pair_win


def pair_metrics(df: DataFrame, *, by: Sequence[str] = (), chosen: str = "chosen_score", rejected: str = "rejected_score") -> DataFrame:
    """Ranking loss, strict accuracy and mean reward of both sides."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.avg(pair_loss(chosen, rejected)).alias("loss"),
        F.avg(pair_win(chosen, rejected)).alias("accuracy"),
        F.avg(chosen).alias("chosen_reward_mean"),
        F.avg(rejected).alias("rejected_reward_mean"),
    )


def step_pair_metrics(
    df: DataFrame,
    *,
    accumulation: int,
    by: Sequence[str] = (),
    batch: str = "batch_id",
    scope: str = "last_micro",
    chosen: str = "chosen_score",
    rejected: str = "rejected_score",
) -> DataFrame:
    """Metrics of each optimiser step.

    The loss covers all micro-batches of the step. Accuracy and reward means come
    from the last micro-batch only (``last_micro``) or from all (``group``). Sums
    and counts per micro-batch are the partial state; incomplete groups drop out.
    Unscored pairs (NULL) are left out of the means, not of the micro-batches.
    """
    if scope not in ("last_micro", "group"):
        raise ValueError(f"unknown scope {scope!r}")
    win = pair_win(chosen, rejected)
    parts = {"accuracy": win, "chosen_reward_mean": F.col(chosen), "rejected_reward_mean": F.col(rejected)}
    micro = df.groupBy(*by, batch).agg(
        F.avg(pair_loss(chosen, rejected)).alias("__loss"),
        *[F.sum(c).alias(f"__sum_{name}") for name, c in parts.items()],
        *[F.count(c).alias(f"__n_{name}") for name, c in parts.items()],
    )
    last = F.col(batch) % accumulation == accumulation - 1
    counted = last if scope == "last_micro" else F.lit(True)

    def mean(name: str):
        total, n = (F.sum(F.when(counted, F.col(f"__{part}_{name}"))) for part in ("sum", "n"))
        return F.try_divide(total, n).alias(name)

    return (
        micro.groupBy(*by, idiv(batch, accumulation).alias("accum_group"))
        .agg(
            F.count(F.lit(1)).alias("__micro"),
            F.sum(F.col("__loss") / accumulation).alias("loss"),
            *[mean(name) for name in parts],
        )
        .filter(F.col("__micro") == accumulation)
        .drop("__micro")
    )


def batch_reward_stats(df: DataFrame, *, by: Sequence[str] = ("batch_id",), reward: str = "reward") -> DataFrame:
    """Mean, sample deviation (NULL for one row), least and greatest reward."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(reward).alias("reward_mean"),
        F.stddev_samp(reward).alias("reward_std"),
        F.min(reward).alias("reward_min"),
        F.max(reward).alias("reward_max"),
    )


def accum_loss(
    df: DataFrame, *, accumulation: int, by: Sequence[str] = ("epoch",), batch: str = "batch_id", loss: str = "loss"
) -> DataFrame:
    """Sum of loss/accumulation per complete accumulation group (one row per micro-batch in)."""
    return (
        df.groupBy(*by, idiv(batch, accumulation).alias("accum_group"))
        .agg(F.count(F.lit(1)).alias("__n"), F.sum(F.col(loss) / accumulation).alias("accumulated_loss"))
        .filter(F.col("__n") == accumulation)
        .drop("__n")
    )


def eval_loss(df: DataFrame, *, batch: Sequence[str], by: Sequence[str] = (), loss: str = "loss", tokens: str | None = None) -> DataFrame:
    """Mean of batch losses, 0 when there is no batch (a short last batch counts in full).

    A batch's loss is the mean of its rows' losses; with ``tokens``, where ``loss`` is summed over each
    row's tokens, it is the mean over all tokens of the batch.
    """
    mean = F.try_divide(F.sum(loss), F.sum(tokens)) if tokens else F.avg(loss)
    batches = df.groupBy(*by, *batch).agg(mean.alias("__m"))
    return batches.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_batches"), F.coalesce(F.avg("__m"), F.lit(0.0)).alias("eval_loss")
    )


def metric_merge(layers: Sequence[DataFrame], *, key: Sequence[str], name: str = "name", value: str = "value") -> DataFrame:
    """Long metric tables merged; where several hold a name, the last one wins."""
    ranked = [d.select(*key, name, value, F.lit(i).alias("__layer")) for i, d in enumerate(layers)]
    union = ranked[0]
    for d in ranked[1:]:
        union = union.unionByName(d)
    # a struct keeps a NULL value of the winning layer from being skipped
    winner = F.max_by(F.struct(F.col(value).alias("v")), F.col("__layer"))
    return union.groupBy(*key, name).agg(winner.alias("__w")).select(*key, name, F.col("__w.v").alias(value))


def sample_preview(df: DataFrame, *, every: int = 10, batch: str = "batch_id", pos: str = "pos", text: str = "response", chars: int = PREVIEW_CHARS) -> DataFrame:
    """The start of the first response of every ``every``-th batch."""
    return df.filter((F.col(batch) % every == 0) & (F.col(pos) == 0)).select(batch, preview(text, chars).alias("sample"))


# How each kind of number is printed in logs and reports.
LOSS_FORMAT = "%.4f"
ACCURACY_FORMAT = "%.3f"
RATE_FORMAT = "%.2e"
COUNT_FORMAT = "%,d"


def metric_format(df: DataFrame, formats: dict[str, str]) -> DataFrame:
    """Replace numeric columns by their printed form."""
    return df.withColumns({c: F.format_string(f, F.col(c)) for c, f in formats.items()})
