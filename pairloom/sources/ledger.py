"""Which stages still have to run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

LEDGER_SCHEMA = "run STRING, stage STRING, output STRING"


def stage_todo(planned: DataFrame, done: DataFrame, *, on: Sequence[str] = ("run", "stage"), always: str = "always") -> DataFrame:
    """Planned stages without an entry in ``done``; those flagged ``always`` stay."""
    marks = done.select(*on).distinct().withColumn("__done", F.lit(True))
    return (
        planned.join(marks, list(on), "left")
        .filter(F.col("__done").isNull() | F.col(always))
        .drop("__done")
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def read_ledger(spark: SparkSession, path: str, *, run: str | None = None) -> DataFrame:
    """The ledger, empty when nothing was recorded yet.

    With ``run``, that run's entries whose output is still there: a stage whose output was deleted has to run again.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    entries = spark.read.schema(LEDGER_SCHEMA).json(path)
    if run is None:
        return entries
    # a run has as many outputs as stages
    own = entries.filter(F.col("run") == run).distinct().collect()
    return spark.createDataFrame([r for r in own if path_exists(spark, r["output"])], LEDGER_SCHEMA)


def record_stage(spark: SparkSession, path: str, *, run: str, stage: str, output: str) -> None:
    """Append one entry after the stage's output is complete."""
    spark.createDataFrame([(run, stage, output)], LEDGER_SCHEMA).coalesce(1).write.mode("append").json(path)
