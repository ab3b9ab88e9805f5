"""Stable row positions without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.numeric import as_col, seeded_hash
from ..session import store
from .joins import BROADCAST_ROWS, attach
from .prefix import levels_for, sums_before

_POSITION_BITS = 33  # monotonically_increasing_id(): partition number above, row number below
_FEW_GROUPS = 1024


def row_index(
    df: DataFrame,
    order_by: Sequence[str | Column],
    *,
    partition_by: Sequence[str] = (),
    name: str = "idx",
    size_name: str | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in the order ``order_by``.

    With ``partition_by`` the position restarts in each group and ``size_name``
    adds the group's row count. Order and group columns must be non-null and
    together unique.

    One range shuffle sorts by the whole key, so a group (or first key) that
    holds a third of all rows is still cut into many tasks. The sorted rows are
    written once with (partition, place) numbers; a joined table of the rows before each
    partition, one row per task, turns these into positions. Writing first matters: range bounds are
    sampled, so counts and places must come from the same run of the sort.
    """
    return indexed(df, order_by, partition_by=partition_by, name=name, size_name=size_name)[0]


def indexed(
    df: DataFrame,
    order_by: Sequence[str | Column],
    *,
    partition_by: Sequence[str] = (),
    name: str = "idx",
    size_name: str | None = None,
) -> tuple[DataFrame, int]:
    """``row_index`` together with the number of rows."""
    spark, groups = df.sparkSession, list(partition_by)
    placed = df.orderBy(*groups, *order_by).withColumn("__slot", F.monotonically_increasing_id())
    stored = store(placed, "row-index")
    part = F.shiftright("__slot", _POSITION_BITS)
    sizes = stored.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    most = _most_partitions(spark)
    offsets = store(partition_offsets(sizes, most), "row-offsets")
    side = F.broadcast(offsets) if most <= BROADCAST_ROWS else offsets
    place = F.col("__slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    out = stored.withColumn("__part", part).join(side.drop("__rows"), "__part").withColumn(name, F.col("__rows_before") + place)
    out = out.drop("__part", "__rows_before")
    total = offsets.agg(F.coalesce(F.sum("__rows"), F.lit(0)).alias("n")).first()["n"]
    if groups:
        out = _restart(out, groups, name, size_name)
    elif size_name:
        out = out.withColumn(size_name, F.lit(total).cast("bigint"))
    return out.drop("__slot"), total


def _most_partitions(spark: SparkSession) -> int:
    """How many partitions a sort can have: a row of offsets each."""
    first = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(first or 0))


def partition_offsets(sizes: DataFrame, partitions: int) -> DataFrame:
    """(__part, __rows, __rows_before): rows before each partition, summed in blocks of partitions."""
    return sums_before(sizes, step="__part", values=["__rows"], levels=levels_for(partitions))


def _restart(df: DataFrame, groups: list[str], name: str, size_name: str | None) -> DataFrame:
    firsts = df.groupBy(*groups).agg(
        F.min(name).alias("__first"),
        F.count(F.lit(1)).alias("__n"),
    )
    few = firsts.limit(_FEW_GROUPS + 1).collect()
    if len(few) <= _FEW_GROUPS:
        side = df.sparkSession.createDataFrame(few, firsts.schema)
        df = df.join(F.broadcast(side), groups, "left")
    else:
        sized = firsts.withColumn("__weight_n", F.col("__n"))
        df = attach(df, sized, groups, weight="__weight_n", spread=["__slot"])
    df = df.withColumn(name, F.col(name) - F.col("__first"))
    if size_name:
        df = df.withColumn(size_name, F.col("__n"))
    return df.drop("__first", "__n")


def hash_order_index(
    df: DataFrame,
    key: str,
    *,
    seed: int,
    within: Sequence[str] = (),
    name: str = "idx",
    prefix: int = 4,
) -> DataFrame:
    """Position of each row in a seeded pseudo-random order, restarting per ``within``.

    Rows are ordered by md5(key|seed|within...). A hash is uniform, so its first
    ``prefix`` hex digits are balanced buckets known in advance: no sampling, no
    written table. ``key`` must be unique within a group. At most 16^prefix
    counts per group are summed up to give bucket offsets.
    """
    within = list(within)
    hashed = df.withColumn("__h", seeded_hash(key, seed, *within)).withColumn(
        "__bucket", F.substring("__h", 1, prefix)
    )
    before = Window.partitionBy(*within).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy(*within, "__bucket")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(*within, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    )
    inside = Window.partitionBy(*within, "__bucket").orderBy("__h", as_col(key))
    return (
        hashed.withColumn("__place", F.row_number().over(inside))
        .join(offsets, [*within, "__bucket"])
        .withColumn(name, F.col("__offset") + F.col("__place") - F.lit(1).cast("bigint"))
        .drop("__h", "__bucket", "__place", "__offset")
    )
