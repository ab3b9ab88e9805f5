"""Stage models fitted by Spark: pairwise reward head, add-one bigram language model."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import tokens as tk
from ..functions.numeric import as_col, dot, literal_vector, softplus
from ..session import release, store, store_parts, temporary
from .joins import attach, fits_broadcast

TEXT_FEATURES = ("log_chars", "tokens_per_char", "distinct_share", "digit_share", "upper_share", "newline_share")

# Divergence settings of the policy stage.
KL_COEF = 0.2
TARGET_KL = 0.1

#: Pairs of tokens that are broadcast with their scores: a fixed number, some 30 MB.
HOT_PAIRS = 1 << 18
#: Bytes of text whose tokens are worked on at once, as long as that takes no more than so many rounds of a fit or of scores.
ROUND_BYTES = 16 << 20
FIT_ROUNDS = 3
ROUNDS = 6


def text_features(text: Column | str) -> Column:
    """Six DOUBLE features of a text, in the order of TEXT_FEATURES."""
    t = as_col(text)
    chars = F.greatest(F.length(t), F.lit(1)).cast("double")
    toks = tk.tokens(t)
    n = F.greatest(F.size(toks), F.lit(1)).cast("double")

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace(t, pattern, "")).cast("double") / chars

    return F.array(
        F.log1p(F.length(t).cast("double")),
        F.size(toks).cast("double") / chars,
        F.size(F.array_distinct(toks)).cast("double") / n,
        share("[^0-9]"),
        share("[^A-Z]"),
        share("[^\\n]"),
    )


def pair_vectors(pairs: DataFrame, *, chosen: str = "chosen_feature", rejected: str = "rejected_feature") -> DataFrame:
    """chosen - rejected with label 1, and its mirror image with label 0."""
    diff = F.zip_with(chosen, rejected, lambda c, r: c.cast("double") - r.cast("double"))
    both = F.array(
        F.struct(diff.alias("d"), F.lit(1.0).alias("label")),
        F.struct(F.transform(diff, lambda x: -x).alias("d"), F.lit(0.0).alias("label")),
    )
    return (
        pairs.filter(F.col(chosen).isNotNull() & F.col(rejected).isNotNull())
        .select(F.explode(both).alias("e"))
        .select(array_to_vector("e.d").alias("features"), "e.label")
    )


def reward_fit(pairs: DataFrame, *, reg: float = 1e-3, max_iter: int = 50, **columns: str) -> LogisticRegressionModel:
    """Fit w so that sigmoid(w . (chosen - rejected)) is the chance that chosen wins.

    This minimises the ranking loss with a penalty of reg/2 |w|^2 on the weights as they are. Gradients
    are summed in the executors; the driver holds one vector of weights. ``refine_head`` takes them on to the exact optimum.
    """
    solver = LogisticRegression(fitIntercept=False, regParam=reg, maxIter=max_iter, tol=1e-8, standardization=False)
    return solver.fit(pair_vectors(pairs, **columns))


def head_weights(model: LogisticRegressionModel) -> list[float]:
    return [float(x) for x in model.coefficients]


@dataclass(frozen=True)
class BigramModel:
    """Counts of (previous token, token), counts of previous tokens, vocabulary
    size, and whether the table of previous tokens was measured to fit a broadcast."""

    bigrams: DataFrame
    contexts: DataFrame
    vocab_size: int
    few_contexts: bool


BEGIN = "<s>"
PAIR = ["prev", "tok"]


def bigrams(df: DataFrame, *, key: str, text: Column | str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """(key, keep..., pos, prev, tok) for every token; pairs are made inside the row, no shuffle."""
    return _token_pairs(df.select(key, *keep, tk.tokens(text).alias("__t")), key, keep)


def _token_pairs(toks: DataFrame, key: str, keep: Sequence[str] = ()) -> DataFrame:
    """``bigrams`` of rows whose tokens are in the column __t."""
    prev = F.slice(F.concat(F.array(F.lit(BEGIN)), "__t"), F.lit(1), F.size("__t"))
    pairs = toks.select(key, *keep, prev.alias("prev"), F.col("__t").alias("tok"))
    return pairs.select(key, *keep, F.posexplode(F.arrays_zip("prev", "tok")).alias("pos", "__g")).select(
        key, *keep, "pos", "__g.prev", "__g.tok"
    )


def _rounds(df: DataFrame, text: Column | str, most: int) -> int:
    """In how many rounds the tokens of ``df`` are worked on: shuffle files of all of them would take many times the room of the texts."""
    size = df.agg(F.sum(F.octet_length(as_col(text)))).first()[0] or 0
    return min(most, size // ROUND_BYTES + 1)


def _written_tokens(df: DataFrame, key: str, text: Column | str) -> DataFrame:
    """(key, __t): texts are cut into tokens once, not in every round."""
    return store(df.select(key, tk.tokens(text).alias("__t")), "tokens", compression="zstd")


def _of_round(table: DataFrame, r: int, rounds: int) -> DataFrame:
    """The rows of a table whose ``prev`` falls to round ``r``."""
    return table if rounds == 1 else table.filter(F.pmod(F.xxhash64("prev"), F.lit(rounds)) == r)


def _counted(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("prev", "tok").agg(F.count(F.lit(1)).alias("n"))


def lm_counts(df: DataFrame, *, key: str, text: Column | str = "text") -> DataFrame:
    return _counted(bigrams(df, key=key, text=text))


def lm_fit(df: DataFrame, *, key: str, text: Column | str = "text") -> BigramModel:
    """Add-one bigram model. The count table is written once, in rounds by the previous token; both uses read it."""
    rounds = _rounds(df, text, FIT_ROUNDS)
    if rounds == 1:
        counts = store(lm_counts(df, key=key, text=text), "bigrams")
    else:
        tokens = _written_tokens(df, key, text)
        counts = store_parts((_counted(_of_round(_token_pairs(tokens, key), r, rounds)) for r in range(rounds)), "bigrams", compression="zstd")
        release(tokens)
    contexts = store(counts.groupBy("prev").agg(F.sum("n").alias("n_prev")), "contexts")
    size = counts.select("tok").distinct().count()
    return BigramModel(counts, contexts, size, fits_broadcast(contexts))


def pair_nll(wanted: DataFrame, model: BigramModel, *, name: str = "nll") -> DataFrame:
    """-ln((n + 1) / (N + V)) for each distinct (prev, tok, ...) of ``wanted``."""
    seen = wanted.join(model.bigrams, ["prev", "tok"], "left")
    if model.few_contexts:
        seen = seen.join(F.broadcast(model.contexts), "prev", "left")
    else:
        used = wanted.groupBy("prev").agg(F.count(F.lit(1)).alias("__uses"))
        contexts = used.join(model.contexts, "prev", "left")
        seen = attach(seen, contexts, ["prev"], weight="__uses", spread=["prev", "tok"])
    p = (F.coalesce("n", F.lit(0)) + F.lit(1.0)) / (F.coalesce("n_prev", F.lit(0)) + F.lit(float(model.vocab_size)))
    return seen.withColumn(name, -F.log(p)).drop("n", "n_prev")


def _heaviest(table: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, those of the highest ``weight``, cut where an eighth of a power of two ends: no task merges the tops of all others."""
    step = F.floor(F.log2("weight") * 8).cast("int")
    least, n = None, 0
    for s, rows in sorted(table.groupBy(step.alias("s")).agg(F.count(F.lit(1))).collect(), reverse=True):  # some 300 at most
        n += rows
        if n > most:
            break
        least = s
    return table.limit(0) if least is None else table.filter(step >= least)


def text_nll(df: DataFrame, models: dict[str, BigramModel], *, key: str, text: Column | str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Summed negative log-likelihood of each text under each model (one column per name).

    Many texts are worked on in rounds: their tokens are written once, and a round takes the pairs of a share of the previous
    tokens, writes the sums by text and deletes what else it wrote. The frequent pairs of all rounds are summed in one more
    pass. Columns to ``keep`` are joined to the sums at the end.
    """
    rounds = _rounds(df, text, ROUNDS)
    if rounds == 1:
        pairs = bigrams(df, key=key, text=text)
        sums, hot = _rare_sums(pairs, models, key, HOT_PAIRS)
        if hot is not None:
            sums = _added(_summed(pairs.join(F.broadcast(hot), PAIR), models, key).unionByName(sums), models, key)
    else:
        tokens = _written_tokens(df, key, text)
        pairs, parts, frequent = _token_pairs(tokens, key), [], []
        for r in range(rounds):
            own = {name: replace(m, bigrams=_of_round(m.bigrams, r, rounds), contexts=_of_round(m.contexts, r, rounds)) for name, m in models.items()}
            with temporary("text-sums", "hot-pairs"):
                sums, hot = _rare_sums(_of_round(pairs, r, rounds), own, key, HOT_PAIRS // rounds)
                parts.append(store(sums, "text-sums"))
            frequent += [] if hot is None else [hot]
        if frequent:
            hot = functools.reduce(DataFrame.union, frequent)
            parts.append(store(_summed(pairs.join(F.broadcast(hot), PAIR), models, key), "text-sums"))
        release(tokens, *frequent)
        sums = _added(functools.reduce(DataFrame.union, parts), models, key)
    return df.select(key, *keep).join(sums, key) if keep else sums


def _added(parts: DataFrame, models: dict[str, BigramModel], key: str) -> DataFrame:
    return parts.groupBy(key).agg(*[F.sum(c).alias(c) for c in ("n_tokens", *models)])


def _summed(scored: DataFrame, models: dict[str, BigramModel], key: str) -> DataFrame:
    return scored.groupBy(key).agg(F.count(F.lit(1)).alias("n_tokens"), *[F.sum(name).alias(name) for name in models])


def _rare_sums(pairs: DataFrame, models: dict[str, BigramModel], key: str, most: int) -> tuple[DataFrame, DataFrame | None]:
    """(key, n_tokens, one column per model), sums over the pairs (key, prev, tok) of each text but for the frequent ones, and the written table
    of those with their scores; it is None when the sums cover all pairs.

    Probabilities are worked out once per distinct pair and written. All of a small table are broadcast, so that tokens are summed where they are
    read. Of a larger one up to ``most`` of the most frequent pairs are to be; only tokens of the others are shuffled to their
    probability, none of them with more than about 1/most of the tokens.
    """
    pairs = pairs.select(key, "prev", "tok")
    wanted = pairs.groupBy("prev", "tok").agg(F.count(F.lit(1)).alias("weight"))
    table = store(wanted, "pairs", compression="zstd")  # read several times below
    for name, model in models.items():
        before, table = table, store(pair_nll(table, model, name=name), "pair-nll", compression="zstd")
        release(before)
    if fits_broadcast(table):
        return _summed(pairs.join(F.broadcast(table.drop("weight")), PAIR), models, key), None
    hot = store(_heaviest(table, most).drop("weight"), "hot-pairs")
    rest = pairs.join(F.broadcast(hot.select(*PAIR)), PAIR, "left_anti")
    return _summed(rest.join(table.drop("weight"), PAIR), models, key), hot


def kl_watch(scored: DataFrame, *, by: Sequence[str], policy: str = "policy", reference: str = "reference", reward: str | None = None, coef: float = KL_COEF, target: float = TARGET_KL) -> DataFrame:
    """Mean log-ratio of policy to reference per group, penalised reward, over-target flag.

    Inputs are negative log-likelihoods, so the log-ratio is reference - policy.
    """
    ratio = F.col(reference) - F.col(policy)
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.avg(ratio).alias("kl")]
    if reward:
        aggs.append(F.avg(F.col(reward) - coef * ratio).alias("penalised_reward"))
    return scored.groupBy(*by).agg(*aggs).withColumn("over_target", F.col("kl") > target)


def feature_differences(pairs: DataFrame, *, chosen: str = "chosen_feature", rejected: str = "rejected_feature", keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., d): chosen - rejected of every pair with both sides."""
    diff = F.zip_with(chosen, rejected, lambda c, r: c.cast("double") - r.cast("double"))
    return pairs.filter(F.col(chosen).isNotNull() & F.col(rejected).isNotNull()).select(*keep, diff.alias("d"))


@dataclass(frozen=True)
class HeadState:
    """The ranking objective at some weights, summed over all pairs: loss, gradient and curvature, each per pair, with the penalty."""

    loss: float
    gradient: np.ndarray
    curvature: np.ndarray
    pairs: int


def head_state(differences: DataFrame, weights: Sequence[float], reg: float) -> HeadState:
    """One pass over the differences; tasks send up one row of sums each."""
    m = len(weights)
    margin = dot("d", literal_vector(list(weights)))
    lost = F.lit(1.0) / (F.lit(1.0) + F.exp(margin))  # chance that the rejected side wins
    base = differences.select("d", softplus(-margin).alias("l"), lost.alias("s"), (lost * (1.0 - lost)).alias("c"))
    upper = [(j, k) for j in range(m) for k in range(j, m)]
    sums = [F.avg("l").alias("loss"), F.count("l").alias("n")]
    sums += [F.avg(F.col("s") * F.col("d")[j]).alias(f"g{j}") for j in range(m)]
    sums += [F.avg(F.col("c") * F.col("d")[j] * F.col("d")[k]).alias(f"h{j}_{k}") for j, k in upper]
    row = base.agg(*sums).first()
    w = np.array(weights, float)
    if not row["n"]:
        raise ValueError("no pair has both sides")
    curvature = np.zeros((m, m))
    for j, k in upper:
        curvature[j, k] = curvature[k, j] = row[f"h{j}_{k}"]
    gradient = reg * w - np.array([row[f"g{j}"] for j in range(m)])
    return HeadState(row["loss"] + reg / 2 * float(w @ w), gradient, curvature + reg * np.eye(m), row["n"])


def refine_head(differences: DataFrame, weights: Sequence[float], *, reg: float = 1e-3, tol: float = 1e-11, max_steps: int = 30) -> list[float]:
    """Weights at the one optimum of the penalised ranking loss, by Newton steps from ``weights``.

    mean softplus(-w.d) + reg/2 |w|^2 is strictly convex, so the result does not depend on the start, the solver or the
    partitioning; the gradient there is below ``tol``, which is checked. A step that does not lower the loss is halved. Made for heads
    of a few dozen features: a pass sums m^2/2 numbers.
    """
    w = np.array(weights, float)
    state = head_state(differences, w, reg)
    for _ in range(max_steps):
        if np.abs(state.gradient).max() < tol:
            return w.tolist()
        step = np.linalg.solve(state.curvature, state.gradient)
        for _ in range(20):
            ahead = head_state(differences, w - step, reg)
            if ahead.loss <= state.loss + 1e-13:
                break
            step = step / 2
        w, state = w - step, ahead
    if np.abs(state.gradient).max() < 100 * tol:
        return w.tolist()
    raise RuntimeError(f"no optimum after {max_steps} steps: gradient {np.abs(state.gradient).max():g}")
