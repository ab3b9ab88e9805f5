"""The run log: metric records in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

LOG_SCHEMA = T.StructType(
    [
        T.StructField("step", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("run", T.StringType()),
        T.StructField("stage", T.StringType()),
    ]
)


def metrics_long(df: DataFrame, *, stage: str, metrics: Sequence[str], run: str = "run", step: str = "step") -> DataFrame:
    """One row per (run, step, metric), the names prefixed by the stage; NULL values are kept."""
    wide = df.select(
        F.lit(stage).alias("stage"),
        F.col(step).cast("bigint").alias("step"),
        F.col(run).cast("string").alias("run"),
        *[F.col(m).cast("double").alias(f"{stage}/{m}") for m in metrics],
    )
    return wide.unpivot(["stage", "step", "run"], [f"{stage}/{m}" for m in metrics], "name", "value")


def append_log(df: DataFrame, path: str) -> None:
    """Append long metrics to the log, one folder per run and stage."""
    _writer(df).mode("append").parquet(path)


def replace_log(df: DataFrame, path: str) -> None:
    """Write the metrics of a stage anew: a repeated stage leaves no second copy.

    Only the folders of the runs and stages in ``df`` are replaced.
    """
    _writer(df).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def _writer(df: DataFrame):
    return df.select(*LOG_SCHEMA.fieldNames()).write.partitionBy("run", "stage")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)
