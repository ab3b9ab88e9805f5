"""Reading comparison tables (prompt, chosen, rejected)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

REQUIRED = ("prompt", "chosen", "rejected")

COMPARISON_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in REQUIRED])


def load_comparisons(
    spark: SparkSession,
    path: str,
    *,
    file_format: str = "parquet",
    schema: T.StructType | None = None,
    split: str | None = None,
) -> DataFrame:
    """Read a comparisons dataset and check its columns.

    JSON is read with an explicit schema (no inference pass over the files). On
    a table partitioned by ``split``, asking for one prunes the other's files.
    """
    reader = spark.read.format(file_format)
    if schema is None and file_format == "json":
        schema = COMPARISON_SCHEMA
    if schema is not None:
        reader = reader.schema(schema)
    df = check_columns(reader.load(path))
    return split_select(df, split) if split else df


def check_columns(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema}
    missing = [c for c in required if c not in types]
    if missing:
        raise ValueError(f"comparisons table lacks {', '.join(missing)}")
    wrong = [c for c in required if not isinstance(types[c], T.StringType)]
    if wrong:
        raise TypeError(f"not STRING: {', '.join(wrong)}")
    return df


def split_select(df: DataFrame, split: str) -> DataFrame:
    return df.filter(F.col("split") == split)


def _any_null(columns: tuple[str, ...]):
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def complete_rows(df: DataFrame, columns: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Rows fit for rendering: no NULL text."""
    return df.filter(~_any_null(columns))


def quarantine(df: DataFrame, columns: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Rows with a NULL text."""
    return df.filter(_any_null(columns))


GOOD = "kept"
_RAW = "raw"


def read_json_rows(spark: SparkSession, path: str, *, extra: str = "", required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """JSON lines as rows with the texts ``required``, the fields of ``extra`` (DDL), ``reason``, ``raw`` and ``file``.

    Every line that is not blank is one row. ``reason`` is ``kept`` for a row whose required fields are all texts, and otherwise says
    what is wrong with the first one that is not: ``malformed`` (the line is no JSON, or breaks off), ``not an object``, ``missing <field>``,
    ``null <field>`` or ``not text <field>``: a number is not taken for a text. Of a line with several values the first counts. Rows that are not kept have null fields and the line
    in ``raw``. The schema is given, so nothing is inferred, and one pass reads and judges.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    lines = lines.filter(F.trim(F.regexp_replace("value", r"\s+", " ")) != "")
    parsed = lines.withColumn("__v", F.try_parse_json("value"))
    kind = F.schema_of_variant("__v")
    reason = F.when(F.col("__v").isNull(), "malformed").when(~F.startswith(kind, F.lit("OBJECT")), "not an object")
    for c in required:
        field = F.try_variant_get("__v", f"$.{c}", "variant")
        own = F.schema_of_variant(field)
        reason = reason.when(field.isNull(), f"missing {c}").when(own == "VOID", f"null {c}").when(own != "STRING", f"not text {c}")
    judged = parsed.withColumn("reason", reason.otherwise(GOOD))
    good = F.col("reason") == GOOD
    texts = [F.when(good, F.try_variant_get("__v", f"$.{c}", "string")).alias(c) for c in required]
    more = [F.when(good, F.try_variant_get("__v", f"$.{f.name}", f.dataType.simpleString())).alias(f.name) for f in T.StructType.fromDDL(extra).fields] if extra else []
    return judged.select(*texts, *more, "reason", F.when(~good, F.col("value")).alias(_RAW), "file")


def load_json(spark: SparkSession, path: str, *, extra: str = "") -> tuple[DataFrame, DataFrame]:
    """The rows of JSON lines that are fit for use, and the quarantined lines (reason, raw, file)."""
    rows = read_json_rows(spark, path, extra=extra)
    return check_columns(rows.filter(F.col("reason") == GOOD).drop("reason", _RAW, "file")), rows.filter(F.col("reason") != GOOD).select("reason", _RAW, "file")
