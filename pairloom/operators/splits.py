"""Stage splits: slices of the row order, their report and their leakage audit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.chat import normalise
from ..functions.numeric import as_col
from .joins import attach


@dataclass(frozen=True)
class Stage:
    """Rows ``start <= idx < end`` belong to ``name``."""

    name: str
    start: int
    end: int


@dataclass(frozen=True)
class StagePlan:
    """Disjoint ranges in row order; the one place where stage borders are kept."""

    stages: tuple[Stage, ...]

    def __post_init__(self) -> None:
        at = 0
        for s in self.stages:
            if s.start < at or s.end < s.start:
                raise ValueError(f"stage {s.name!r} overlaps an earlier one or is reversed")
            at = s.end

    @classmethod
    def scaled(cls, n: int) -> StagePlan:
        """The default proportions for a small table: 40% sft, 30% reward, a gap, 10% policy."""
        return cls(
            (
                Stage("sft", 0, n * 4 // 10),
                Stage("reward", n * 4 // 10, n * 7 // 10),
                Stage("policy", n * 8 // 10, n * 9 // 10),
            )
        )

    def gaps(self) -> list[Stage]:
        """Ranges between stages that no stage uses (the open end is not one)."""
        out, at = [], 0
        for s in self.stages:
            if s.start > at:
                out.append(Stage(f"gap_before_{s.name}", at, s.start))
            at = max(at, s.end)
        return out

    def label(self, idx: Column | str, *, with_gaps: bool = False) -> Column:
        """CASE over literal ranges: a range table would need a nested-loop join."""
        i = as_col(idx)
        out = None
        for s in [*self.stages, *(self.gaps() if with_gaps else [])]:
            test = (i >= s.start) & (i < s.end)
            out = F.when(test, F.lit(s.name)) if out is None else out.when(test, F.lit(s.name))
        return out.otherwise(F.lit("unused")) if out is not None else F.lit("unused")


# The stage borders of the full-size run. Rows 20000-24999 were
# planned for the reward stage but no stage reads them.
DEFAULT_PLAN = StagePlan((Stage("sft", 0, 10_000), Stage("reward", 10_000, 20_000), Stage("policy", 25_000, 30_000)))


def head_n(df: DataFrame, n: int, *, idx: str = "idx", strict: bool = False) -> DataFrame:
    """The first ``n`` rows; ``strict`` fails when there are fewer."""
    out = df.filter(F.col(idx) < n)
    if strict:
        found = out.count()
        if found != n:
            raise ValueError(f"asked for {n} rows, the table has {found}")
    return out


def slice_rows(df: DataFrame, start: int, end: int, *, idx: str = "idx") -> DataFrame:
    """Rows ``start <= idx < end``; a range past the table is cut, never an error."""
    return df.filter((F.col(idx) >= start) & (F.col(idx) < end))


def stage_assign(df: DataFrame, plan: StagePlan, *, idx: str = "idx") -> DataFrame:
    return df.withColumn("stage", plan.label(idx))


def split_report(df: DataFrame, plan: StagePlan, *, idx: str = "idx") -> DataFrame:
    """Rows and index range per stage, and per gap that the plan leaves uncovered.

    Every planned stage and gap has a line, also one without rows (0 rows, no range).
    """
    names = [s.name for s in (*plan.stages, *plan.gaps())]
    lines = df.sparkSession.sql("SELECT explode(array({})) AS stage".format(", ".join(f"'{n}'" for n in names) or "CAST(NULL AS STRING)"))
    found = (
        df.select(plan.label(idx, with_gaps=True).alias("stage"), F.col(idx).alias("__i"))
        .groupBy("stage")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("__i").alias("first_idx"),
            F.max("__i").alias("last_idx"),
        )
    )
    return (
        lines.filter("stage IS NOT NULL")
        .join(found, "stage", "full")
        .withColumn("n_rows", F.coalesce("n_rows", F.lit(0).cast("bigint")))
        .withColumn("range", F.concat(F.col("first_idx").cast("string"), F.lit("-"), F.col("last_idx").cast("string")))
        .withColumn("is_gap", F.when(F.col("stage").startswith("gap_"), 1).otherwise(0).cast("bigint"))
    )


def hash_texts(df: DataFrame, columns: tuple[str, ...] = ("prompt", "chosen")) -> DataFrame:
    """Replace texts by the digest of their normalised form, so that sorting and
    joining them moves 32 characters instead of the text."""
    return df.withColumns({c: F.md5(normalise(c)) for c in columns})


def repeated_texts(hashed: DataFrame, columns: tuple[str, ...], *, stage: str = "stage") -> DataFrame:
    """Digests with more than one row: how many rows, in how many stages.

    Copies collapse on the map side, so a text with many copies costs one row
    per task; the set of stages is as small as the plan.
    """
    return (
        _long(hashed, columns, (stage,))
        .groupBy("field", "text_hash")
        .agg(
            F.size(F.collect_set(stage)).alias("n_stages"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        .filter("n_rows > 1")
    )


def leakage_audit(
    hashed: DataFrame,
    columns: tuple[str, ...] = ("prompt", "chosen"),
    *,
    idx: str = "idx",
    stage: str = "stage",
) -> DataFrame:
    """Every row whose text also occurs in another stage: (field, idx, stage, text_hash).

    ``hashed`` is a staged table whose ``columns`` went through ``hash_texts``.
    The join also carries texts repeated inside one stage only, because those
    can be the frequent ones; they are dropped afterwards.
    """
    rows = _long(hashed, columns, (idx, stage))
    repeated = repeated_texts(hashed, columns, stage=stage)
    found = attach(rows, repeated, ["field", "text_hash"], weight="n_rows", spread=[idx], how="inner")
    return found.filter("n_stages > 1").drop("n_stages")


def overlapping_rows(df: DataFrame, *, idx: str = "idx", stage: str = "stage") -> DataFrame:
    """Row positions that are assigned to more than one stage."""
    return (
        df.groupBy(idx)
        .agg(F.size(F.collect_set(stage)).alias("n_stages"))
        .filter("n_stages > 1")
    )


def _long(hashed: DataFrame, columns: tuple[str, ...], keep: tuple[str, ...]) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text_hash")) for c in columns])
    return hashed.select(*keep, F.explode(entries).alias("e")).select(*keep, "e.field", "e.text_hash")
