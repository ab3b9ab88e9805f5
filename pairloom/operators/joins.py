"""A lookup join that stays balanced when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

HEAVY_KEYS = 1024
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
_LANES = 1 << 20


def attach(
    left: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    *,
    weight: str,
    spread: Sequence[str],
    how: str = "left",
    heavy: int = HEAVY_KEYS,
) -> DataFrame:
    """Join ``left`` to ``table``, which has one row per key ``on``.

    ``weight`` is a column of ``table`` with the number of left rows of its key
    (or a number in proportion). Keys of ``left`` that the table lacks count as
    rare, so the table must hold every frequent key, if need be with NULL values. The ``heavy`` keys with most weight are broadcast (a fixed number
    of rows, however large the table is); every other key holds at most
    1/(heavy+1) of the weight and goes through an ordinary shuffle join. Rows
    served by the broadcast, and rows with a NULL key, are spread over the
    shuffle by the columns ``spread`` instead of meeting at their key.
    """
    on = list(on)
    extra = [c for c in table.columns if c not in on and c != weight]
    value = F.struct(*[F.col(c) for c in extra]) if extra else F.struct(F.lit(1).alias("hit"))
    slim = table.select(*on, F.col(weight).alias("__weight"), value.alias("__value"))

    top = slim.orderBy(F.desc("__weight"), *on).limit(heavy)
    hot = top.select(*on, F.col("__value").alias("__hot"))
    cold = slim.select(*on, F.col("__value").alias("__cold"), F.lit(0).alias("__lane"))

    has_null = F.lit(False)
    for c in on:
        has_null = has_null | F.col(c).isNull()
    own_lane = (F.pmod(F.xxhash64(*spread), F.lit(_LANES)) + 1).cast("int")
    lane = F.when(F.col("__hot").isNull() & ~has_null, F.lit(0)).otherwise(own_lane)

    joined = (
        left.join(F.broadcast(hot), on, "left")
        .withColumn("__lane", lane)
        .join(cold, [*on, "__lane"], "left")
        .withColumn("__value", F.coalesce("__hot", "__cold"))
    )
    if how in ("inner", "semi"):
        joined = joined.filter(F.col("__value").isNotNull())
    elif how != "left":
        raise ValueError(f"unknown join type {how!r}")
    kept = [F.col(c) for c in left.columns]
    if how != "semi":
        kept += [F.col(f"__value.{c}").alias(c) for c in extra]
    return joined.select(*kept)


def fits_broadcast(table: DataFrame) -> bool:
    """Whether a table is small enough to send to every executor, by measurement.

    Reads the table, so it should be a stored one.
    """
    if table.count() > BROADCAST_ROWS:
        return False
    size = F.octet_length(F.concat_ws(",", *[F.col(c).cast("string") for c in table.columns]))
    return table.agg(F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()["b"] <= BROADCAST_BYTES


def lookup(
    left: DataFrame, stored: DataFrame, on: Sequence[str], *, weight: str, spread: Sequence[str], how: str = "left"
) -> DataFrame:
    """``attach`` for a stored table: measured first, and broadcast whole when it is small."""
    if how in ("left", "inner") and fits_broadcast(stored):
        return left.join(F.broadcast(stored.drop(weight)), list(on), how)
    return attach(left, stored, on, weight=weight, spread=spread, how=how)
