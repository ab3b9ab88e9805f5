"""Drawing one candidate per prompt: temperature, top-k, top-p, seeded draw."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import hash_uniform, seeded_hash


@dataclass(frozen=True)
class SamplingConfig:
    """The generation settings of the policy stage."""

    temperature: float = 0.7
    top_k: int = 50
    top_p: float = 0.95
    min_length: int = 0
    seed: int = 42


def nucleus(df: DataFrame, config: SamplingConfig = SamplingConfig(), *, prompt: str = "prompt_id", candidate: str = "cand_id", logit: str = "logit") -> DataFrame:
    """Candidates that survive top-k and top-p, with their probability ``q`` and
    the mass ``before`` them in rank order.

    Top-k comes first, as a bare rank filter: Spark then keeps k rows per prompt
    in each task before the shuffle, so a prompt with very many candidates is
    never gathered. Everything after works on at most k rows per prompt.
    """
    ranked = Window.partitionBy(prompt).orderBy(F.desc("__z"), F.col(candidate))
    group = Window.partitionBy(prompt)
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    top = (
        df.withColumn("__z", F.col(logit) / config.temperature)
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= config.top_k)
    )
    mass = (
        top.withColumn("__e", F.exp(F.col("__z") - F.max("__z").over(group)))
        .withColumn("__p", F.col("__e") / F.sum("__e").over(group))
        .withColumn("__mass", F.coalesce(F.sum("__p").over(before), F.lit(0.0)))
    )
    kept = mass.filter((F.col("__mass") < config.top_p) | (F.col("rank") == 1))
    return (
        kept.withColumn("q", F.col("__p") / F.sum("__p").over(group))
        .withColumn("before", F.coalesce(F.sum("q").over(before), F.lit(0.0)))
        .drop("__z", "__e", "__p", "__mass")
    )


def sample_candidates(
    df: DataFrame, config: SamplingConfig = SamplingConfig(), *, prompt: str = "prompt_id", candidate: str = "cand_id", logit: str = "logit", length: str | None = None
) -> DataFrame:
    """One candidate id per prompt, drawn with a number hashed from prompt and seed."""
    if config.min_length and length:
        df = df.filter(F.col(length) >= config.min_length)
    drawn = hash_uniform(seeded_hash(prompt, config.seed))
    slim = df.select(prompt, candidate, logit)
    return (
        nucleus(slim, config, prompt=prompt, candidate=candidate, logit=logit)
        .withColumn("__u", drawn)
        .filter(F.col("before") <= F.col("__u"))
        .groupBy(prompt)
        .agg(F.max_by(F.struct(candidate, "q", "rank"), F.col("rank")).alias("__c"))
        .select(prompt, f"__c.{candidate}", F.col("__c.q").alias("q"), F.col("__c.rank").cast("bigint").alias("rank"))
    )
