"""Running sums over numbered rows, in blocks: no window sees more than a block of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import idiv

BLOCK = 1024
_TOP = 1 << 62  # every number divided by it is 0: one group, named by a column


def levels_for(rows: int, block: int = BLOCK) -> int:
    """Levels of blocks after which at most ``block`` of ``rows`` numbers are left."""
    levels = 0
    while rows > block:
        rows, levels = -(-rows // block), levels + 1
    return levels


def sums_before(
    df: DataFrame, *, step: str, values: Sequence[str], run: Sequence[str] = (), suffix: str = "_before", block: int = BLOCK, levels: int = 2
) -> DataFrame:
    """For each of ``values`` its sum over all rows of the run with a lower ``step`` (0 at the first).

    ``step`` is a whole number, once per run. Sums run inside blocks of ``block`` steps, and the blocks' own
    sums one level up; after ``levels`` levels a window over the run sees steps / block^levels rows.
    """
    run, values = list(run), list(values)
    if levels == 0:
        w = Window.partitionBy(*run, idiv(step, _TOP)).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({v + suffix: F.coalesce(F.sum(v).over(w), _zero(df, v)) for v in values})
    at, carry = f"__block{levels}", f"__carried{levels}"
    blocked = df.withColumn(at, idiv(step, block))
    within = Window.partitionBy(*run, at).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    totals = blocked.groupBy(*run, at).agg(*[F.sum(v).alias(v) for v in values])
    above = sums_before(totals, step=at, values=values, run=run, suffix=carry, block=block, levels=levels - 1)
    carried = above.select(*run, at, *[v + carry for v in values])
    inside = blocked.withColumns({v + suffix: F.coalesce(F.sum(v).over(within), _zero(df, v)) for v in values})
    joined = inside.join(carried, [*run, at])
    return joined.withColumns({v + suffix: F.col(v + suffix) + F.col(v + carry) for v in values}).drop(at, *[v + carry for v in values])


def _zero(df: DataFrame, value: str) -> Column:
    return F.lit(0.0) if dict(df.dtypes)[value] == "double" else F.lit(0).cast("bigint")


def moments_upto(
    df: DataFrame, *, run: Sequence[str], step: str, value: str, every: int, block: int = BLOCK, levels: int = 1
) -> DataFrame:
    """Count, mean and deviation of ``value`` over all steps up to each due step, a row per due step.

    Steps count from 1; step k is due when ``every`` divides it and the run reaches it. Each stretch between due steps is reduced to count, mean
    and sum of squared deviations (combined in the tasks first); these are merged over the stretches by running sums about
    the run's mean, so large values lose no digits. Returns run..., step, n, mean, std (sample form, null for one value), last_value and
    the stretch's own stretch_mean. Null values are left out; a stretch without values keeps what was before.
    """
    run = list(run)
    parts = (
        df.withColumn("__part", idiv(F.col(step) + (every - 1), every))
        .groupBy(*run, "__part")
        .agg(
            F.count(value).cast("double").alias("__n"),
            F.avg(value).alias("stretch_mean"),
            F.coalesce(F.var_pop(value) * F.count(value), F.lit(0.0)).alias("__m2"),
            F.max(step).alias("__reached"),
            F.max_by(value, step).alias("last_value"),
        )
    )
    pivot = parts.groupBy(*run).agg(F.coalesce(F.sum(F.col("__n") * F.col("stretch_mean")) / F.sum("__n"), F.lit(0.0)).alias("__pivot"))
    off = F.coalesce(F.col("stretch_mean") - F.col("__pivot"), F.lit(0.0))
    shifted = parts.join(pivot, run).withColumns({"__s1": F.col("__n") * off, "__s2": F.col("__m2") + F.col("__n") * off * off})
    sums = sums_before(shifted, run=run, step="__part", values=["__n", "__s1", "__s2"], suffix="_b", block=block, levels=levels)
    n, s1, s2 = (F.col(v) + F.col(f"{v}_b") for v in ("__n", "__s1", "__s2"))
    spread = F.when(n > 1, F.sqrt(F.greatest(s2 - s1 * s1 / n, F.lit(0.0)) / (n - 1)))
    due = F.col("__part") * every
    return sums.filter(due <= F.col("__reached")).select(
        *run, due.alias(step), n.cast("bigint").alias("n"), F.when(n > 0, F.col("__pivot") + s1 / n).alias("mean"), spread.alias("std"), "last_value", "stretch_mean"
    )
