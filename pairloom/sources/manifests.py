"""Run manifests and reports: JSON and text side files of a stage."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.numeric import as_col, idiv, money
from ..operators.best import best_so_far, prior_min
from ..operators.prefix import moments_upto
from ..operators.splits import StagePlan
from .ledger import path_exists


# The settings of the policy stage that its manifest records.
POLICY_SETTINGS = {"batch_size": 8, "mini_batch_size": 2, "ppo_epochs": 4, "target_kl": 0.1, "learning_rate": 1e-5, "cliprange": 0.2}


def _struct(values: dict) -> Column:
    def field(v):
        if isinstance(v, dict):
            return _struct(v)
        return v if isinstance(v, Column) else F.lit(v)

    return F.struct(*[field(v).alias(k) for k, v in values.items()])


def run_manifest(df: DataFrame, *, keep: Sequence[str], fields: dict) -> DataFrame:
    """A JSON text per row from (nested) columns and constants."""
    return df.select(*keep, F.to_json(_struct(fields), {"ignoreNullFields": "false"}).alias("manifest"))


def plan_ranges(plan: StagePlan) -> dict[str, str]:
    return {f"{s.name}_samples": f"{s.start}-{s.end - 1}" for s in plan.stages}


def write_manifests(df: DataFrame, path: str) -> None:
    """One JSON text per line."""
    df.select("manifest").write.mode("overwrite").text(path)


def read_manifests(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def manifest_field(manifest: Column | str, name: str, ddl: str, default) -> Column:
    """A field of a JSON text; the default when the text, or the key in it, is missing."""
    parsed = F.from_json(as_col(manifest), f"`{name}` {ddl}")
    return F.coalesce(parsed[name], F.lit(default))


def manifest_lookup(runs: DataFrame, manifests: DataFrame, *, key: str, name: str, ddl: str, default, out: str | None = None) -> DataFrame:
    """One field for every run, with a default for runs that left no manifest or no such key."""
    return (
        runs.join(manifests.select(key, "manifest"), key, "left")
        .withColumn(out or name, manifest_field("manifest", name, ddl, default))
        .drop("manifest")
    )


def run_report(
    totals: DataFrame, *, run: str = "run", base: str = "base_model", reward: str = "reward_model", model: str = "model", plan: StagePlan | None = None
) -> DataFrame:
    """A markdown report per run from its totals (steps, reward_mean, reward_std) and, with a plan, the rows of its stages."""
    stages = "".join(f"- {s.name}: rows {s.start}-{s.end - 1}\n" for s in plan.stages) if plan else ""
    text = F.concat(
        F.lit("# Run "), F.col(run).cast("string"),
        F.lit("\n\n## Model\n- Base model: "), F.col(base),
        F.lit("\n- Reward model: "), F.col(reward),
        F.lit("\n- Final model: "), F.col(model),
        F.lit("\n\n## Training\n- Steps: "), F.col("total_steps").cast("string"),
        F.lit("\n- Final reward mean: "), F.coalesce(money("reward_mean", 3), F.lit("n/a")),
        F.lit("\n- Final reward deviation: "), F.coalesce(money("reward_std", 3), F.lit("n/a")),
        F.lit(f"\n\n## Stages\n{stages}" if stages else "\n"),
    )
    return totals.select(run, text.alias("report"))


def write_report(reports: DataFrame, path: str) -> None:
    reports.select("report").write.mode("overwrite").text(path)


def checkpoint_states(
    log: DataFrame, *, run: Sequence[str] = ("run",), step: str = "step", value: str = "loss", every: int, higher_is_better: bool = False
) -> DataFrame:
    """What a checkpoint after each due step (every ``every`` steps, counted from 1) knows of its run.

    Returns run..., step, n, mean and std (over all steps so far), last_value, eval_loss (the mean since the due step
    before), best_loss (the least eval loss so far) and is_best (strictly below every earlier one); with ``higher_is_better``, for
    rewards, the highest so far and strictly above.
    """
    sign = -1.0 if higher_is_better else 1.0
    run = list(run)
    states = moments_upto(log, run=run, step=step, value=value, every=every).withColumnRenamed("stretch_mean", "eval_loss")
    # due steps are numbered 1, 2, ... for the blocks of the running minimum
    placed = states.withColumns({"__k": idiv(step, every), "__judged": F.col("eval_loss") * sign})
    flagged = best_so_far(placed, run=run, step="__k", loss="__judged")
    best = prior_min(flagged, run=run, step="__k", value="__judged", out="__prior")
    return best.withColumn("best_loss", F.least("__prior", "__judged") * sign).drop("__k", "__prior", "__judged")


def write_checkpoints(states: DataFrame, path: str, *, run: str = "run", step: str = "step", settings: dict | None = None) -> None:
    """A JSON manifest per checkpoint, in files below a folder per run: ``run=.../``, a manifest a line."""
    fields = {
        "run": F.col(run), "epoch": F.col(step), "total_steps": F.col("n"), "reward_mean": F.col("mean"), "reward_std": F.col("std"),
        "last_value": F.col("last_value"), "eval_loss": F.col("eval_loss"), "best_loss": F.col("best_loss"), "is_best": F.col("is_best"),
        "model_type": "ppo_checkpoint", **(settings or {}),
    }
    written = run_manifest(states, keep=[run], fields=fields)
    written.select(F.col(run).alias("__run"), "manifest").repartition("__run").write.mode("overwrite").partitionBy("__run").text(path)


CHECKPOINT_SCHEMA = """run STRING, epoch BIGINT, total_steps BIGINT, reward_mean DOUBLE, reward_std DOUBLE, last_value DOUBLE,
    eval_loss DOUBLE, best_loss DOUBLE, is_best BOOLEAN, model_type STRING, base_sft_model STRING, reward_model STRING"""


def write_folders(df: DataFrame, root: str, *, key: str, text: str, folder: str = "{}", file: str = "manifest.txt") -> int:
    """Write the text of each row, with a line end, to ``file`` in the folder of its key below ``root``; returns how many.

    ``key`` must be unique; signs that a folder's name cannot hold are escaped, and a null key and null text are written, as Spark's partition
    writer does. Each task writes its files in place through a file system that all executors reach: there is no
    job commit that moves them one by one, and a task that runs again writes the same files.
    """
    context = df.sparkSession.sparkContext
    tasks = max(context.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = df.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text")).repartition(tasks, "key")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = pafs.FileSystem.from_uri(root)
        n = 0
        for batch in batches:
            for row in batch.to_pylist():
                name = "__HIVE_DEFAULT_PARTITION__" if row["key"] in (None, "") else re.sub(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", row["key"])
                place = f"{base}/{folder.format(name)}"
                system.create_dir(place, recursive=True)
                with system.open_output_stream(f"{place}/{file}", compression=None) as out:
                    out.write(f"{row['text'] or ''}\n".encode())
                n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    return rows.mapInArrow(write, "n bigint").agg(F.sum("n")).first()[0] or 0


def read_folder(spark: SparkSession, root: str, *, key_pattern: str = "([^/]+)/[^/]+$", glob: str | None = None) -> DataFrame:
    """(key, manifest, file): every file below ``root`` as one text, with the key that ``key_pattern`` finds in its path (default: its folder's name).

    No row where there is no folder. A key with several files gives several rows.
    """
    if not path_exists(spark, root):
        return spark.createDataFrame([], "key STRING, manifest STRING, file STRING")
    reader = spark.read.option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    file = F.col("_metadata.file_path")
    # paths are URIs: what a folder's name holds beyond plain characters is escaped in them
    files = reader.text(root, wholetext=True).select(F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B"))).alias("file"), F.col("value").alias("manifest"))
    return files.select(F.regexp_extract("file", key_pattern, 1).alias("key"), "manifest", "file")


def folder_lookup(runs: DataFrame, root: str, *, key: str, name: str, ddl: str, default, folder: str = "{}", glob: str | None = None, out: str | None = None) -> DataFrame:
    """One field for every row of ``runs`` from the manifest file in its folder below ``root``, with its default and why the default was taken.

    ``folder`` is the folder's name with {} for the key. ``reason`` is ``found``, ``absent`` (no file), ``empty``, ``malformed`` (no JSON object), ``no key``
    (the key is missing or null) or ``wrong type``. Of several files in one folder the last by name counts.
    """
    spark = runs.sparkSession
    before, after = (re.escape(p) for p in folder.split("{}"))
    found = read_folder(spark, root, key_pattern=f"{before}([^/]+?){after}/[^/]+$", glob=glob)
    parsed = found.withColumn("__v", F.try_parse_json("manifest"))
    field = F.try_variant_get("__v", f"$.{name}", "variant")
    value = F.try_variant_get("__v", f"$.{name}", ddl)
    kind = F.schema_of_variant("__v")
    why = (
        F.when(F.trim("manifest") == "", "empty")
        .when(F.col("__v").isNull() | ~F.startswith(kind, F.lit("OBJECT")), "malformed")
        .when(field.isNull() | (F.schema_of_variant(field) == "VOID"), "no key")
        .when(value.isNull(), "wrong type")
        .otherwise("found")
    )
    judged = parsed.select("key", F.struct("file", value.alias("value"), why.alias("why")).alias("__m"))
    latest = judged.groupBy(F.col("key").alias("__key")).agg(F.max_by("__m", "__m.file").alias("__m"))
    joined = runs.join(latest, F.col(key).cast("string") == F.col("__key"), "left")
    return joined.withColumns({out or name: F.coalesce("__m.value", F.lit(default)), "reason": F.coalesce("__m.why", F.lit("absent"))}).drop("__m", "__key")
