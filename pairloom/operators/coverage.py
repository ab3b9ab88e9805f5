"""Which row positions written stages cover, read from the rows themselves."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import idiv
from ..session import store

BLOCK = 4096
LEVELS = 3


def _merged(ranges: DataFrame, by: list[str], width: int) -> DataFrame:
    """Ranges (first, last, n) that touch or overlap, joined to one within each bucket of ``width`` positions."""
    bucket = ranges.withColumn("__bucket", idiv("first", width))
    before = Window.partitionBy(*by, "__bucket").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("last").over(before)
    starts = bucket.withColumn("__new", F.when(reach.isNull() | (F.col("first") > reach + 1), 1).otherwise(0))
    upto = Window.partitionBy(*by, "__bucket").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = starts.withColumn("__run", F.sum("__new").over(upto))
    merged = numbered.groupBy(*by, "__bucket", "__run").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"))
    whole = Window.partitionBy(*by, "__bucket")
    edge = (F.col("__run") == 1) | (F.col("__run") == F.max("__run").over(whole))
    return merged.withColumn("__edge", edge)


def islands(rows: DataFrame, *, by: Sequence[str], idx: str = "idx", block: int = BLOCK, levels: int = LEVELS) -> DataFrame:
    """(by..., first, last, n): the longest ranges of positions without a hole, per group; n counts rows, repeated ones too.

    Ranges grow level by level: within blocks of positions first; only the first and the last range of a block can go on in its
    neighbours, so only those go up to the next level, whose blocks are ``block`` times as wide. However the positions
    are scattered, a window sees at most twice ``block`` rows below the last level.
    """
    by = list(by)
    ranges = rows.filter(F.col(idx).isNotNull()).groupBy(*by, F.col(idx).alias("first")).agg(F.count(F.lit(1)).alias("n"))
    ranges = ranges.select(*by, "first", F.col("first").alias("last"), "n")
    done = []
    for level in range(1, levels + 1):
        merged = store(_merged(ranges, by, block**level), f"islands-{level}").select(*by, "first", "last", "n", "__edge")
        done.append(merged.filter(~F.col("__edge")).drop("__edge"))
        ranges = merged.filter("__edge").drop("__edge")
    done.append(_merged(ranges, by, 1 << 62).select(*by, "first", "last", "n"))
    return reduce(DataFrame.unionByName, done)


def uncovered(rows: DataFrame, *, start: int, stop: int, idx: str = "idx", block: int = BLOCK, levels: int = LEVELS) -> DataFrame:
    """(first, last): the ranges of positions from ``start`` up to ``stop`` (not included) that no row has.

    Holes between neighbours within a block are found there; of the block only its hull goes up, and holes between hulls are found one level up.
    """
    spark = rows.sparkSession
    ends = spark.sql(f"SELECT explode(array({start - 1}L, {stop}L)) AS first").withColumn("last", F.col("first"))
    inside = rows.filter((F.col(idx) >= start) & (F.col(idx) < stop)).select(F.col(idx).alias("first"), F.col(idx).alias("last"))
    ranges = inside.unionByName(ends)
    found = []
    for width in [*(block**k for k in range(1, levels + 1)), 1 << 62]:
        bucket = ranges.withColumn("__bucket", idiv(F.col("first") - (start - 1), width))
        w = Window.partitionBy("__bucket").orderBy("first", "last")
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        paired = bucket.select("first", "last", F.max("last").over(upto).alias("__reach"), F.lead("first").over(w).alias("__next"))
        found.append(paired.filter(F.col("__next") > F.col("__reach") + 1).select((F.col("__reach") + 1).alias("first"), (F.col("__next") - 1).alias("last")))
        hulls = bucket.groupBy("__bucket").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("__bucket")
        ranges = store(hulls, "coverage-hulls") if width < 1 << 62 else hulls
    return reduce(DataFrame.unionByName, found)


def coverage_report(rows: DataFrame, total: int, *, stage: str = "stage", idx: str = "idx", block: int = BLOCK, levels: int = LEVELS) -> DataFrame:
    """(stage, first_idx, last_idx, n_rows): what written stage rows cover and what of 0 .. total - 1 no stage does.

    One line per unbroken range of a stage, and one with the stage ``(none)`` and 0 rows per range that is missing from all stages, also
    before the first and after the last row. Rows with a null position are left out; a position twice counts twice.
    """
    # ranges of three levels of blocks cover 4096^3 positions before the last window sees more than a block of them
    held = islands(rows, by=[stage], idx=idx, block=block, levels=levels).select(
        stage, F.col("first").alias("first_idx"), F.col("last").alias("last_idx"), F.col("n").alias("n_rows")
    )
    holes = uncovered(rows.filter(F.col(idx).isNotNull()), start=0, stop=total, idx=idx, block=block, levels=levels)
    none = holes.select(F.lit("(none)").alias(stage), F.col("first").alias("first_idx"), F.col("last").alias("last_idx"), F.lit(0).cast("bigint").alias("n_rows"))
    return held.unionByName(none)
