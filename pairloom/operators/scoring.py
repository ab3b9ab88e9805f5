"""Reward scores for sequences, pairs and rollouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import tokens as tk
from ..functions.chat import DECODED_INSTRUCTION, ChatTemplate, DEFAULT_TEMPLATE, chat_array, extract_post
from ..functions.numeric import as_col, dot, literal_vector
from .encode import Vocabulary, decode_columns, encode
from .joins import attach

DEFAULT_REWARD = 0.0
MAX_LENGTH = 512


def last_position(mask: Column | str) -> Column:
    """0-based place of the last real token; -1 when every place is padding."""
    return F.aggregate(as_col(mask), F.lit(0), lambda a, m: a + m.cast("int")) - 1


def last_token(states: Column | str, mask: Column | str | None = None) -> Column:
    """The state at the last real token; without a mask, at the last place.

    NULL for an all-padding row or a mask that is longer than the states.
    """
    s = as_col(states)
    if mask is None:
        return F.try_element_at(s, F.when(F.size(s) > 0, F.lit(-1)))
    at = last_position(mask)
    return F.try_element_at(s, F.when(at >= 0, at + 1))


def reward_score(feature: Column | str, weights: Sequence[float], bias: float = 0.0) -> Column:
    """Linear reward head."""
    return dot(feature, literal_vector(list(weights)), bias)


def with_default(score: Column | str, default: float = DEFAULT_REWARD) -> tuple[Column, Column]:
    """(reward, defaulted): a row that could not be scored gets the default and is flagged."""
    s = as_col(score)
    return F.coalesce(s, F.lit(float(default))), s.isNull()


def reward_default(df: DataFrame, score: str = "score", *, out: str = "reward") -> DataFrame:
    reward, defaulted = with_default(score)
    return df.withColumn(out, reward).withColumn("defaulted", defaulted)


def score_table(features: DataFrame, *, key: str, feature: str, weights: Sequence[float], bias: float = 0.0) -> DataFrame:
    """(key, score): vectors are reduced to one number before anything joins them."""
    return features.select(key, reward_score(feature, weights, bias).alias("score"))


def score_pairs(
    pairs: DataFrame,
    scores: DataFrame,
    *,
    pair: str = "idx",
    chosen: str = "chosen_id",
    rejected: str = "rejected_id",
    key: str,
    unique: bool = False,
) -> DataFrame:
    """Both sides of each pair scored. ``scores`` has one row per ``key``.

    Pass ``unique`` when no item is in more than one pair. Otherwise the uses of
    each item are counted first, so that one that is in very many pairs is split off.
    """
    for side, out in ((chosen, "chosen_score"), (rejected, "rejected_score")):
        table = scores.select(F.col(key).alias(side), F.col("score").alias(out))
        if unique:
            pairs = pairs.join(table, side, "left")
        else:
            uses = pairs.groupBy(side).agg(F.count(F.lit(1)).alias("__uses"))
            pairs = attach(pairs, uses.join(table, side, "left"), [side], weight="__uses", spread=[pair])
    return pairs


def rollout_join(queries: DataFrame, responses: DataFrame, *, on: Sequence[str] = ("batch_id", "pos")) -> DataFrame:
    """Queries with responses at the same place; what only one side has is dropped."""
    return queries.join(responses, list(on), "inner")


def rollout_chats(
    logged: DataFrame,
    vocab: Vocabulary,
    *,
    key: str = "idx",
    query_ids: str = "query_ids",
    response_ids: str = "response_ids",
    keep: Sequence[str] = (),
    template: ChatTemplate = DEFAULT_TEMPLATE,
    mode: str = "first_line",
) -> DataFrame:
    """Logged id sequences back to the chat the reward head was fitted on.

    Decoded text separates tokens by a blank, so the instruction is looked for in
    its decoded form. Rows whose post cannot be found have a NULL chat.
    """
    texts = decode_columns(logged, vocab, {query_ids: "query_text", response_ids: "response_text"}, key=key, keep=keep)
    post = extract_post("query_text", marker=DECODED_INSTRUCTION, mode=mode, template=template)
    rebuilt = template.render(chat_array("post", "response_text"))
    return texts.withColumn("post", post).withColumn("chat_text", rebuilt).drop("query_text")


def id_features(ids: Column | str) -> Column:
    """What the chat head sees of an id sequence: log length, share of distinct ids, share of reserved ids and pieces."""
    a = as_col(ids)
    n = F.size(a).cast("double")
    share = lambda x: F.when(n > 0, F.size(x) / n).otherwise(0.0)
    return F.array(F.log1p(n), share(F.array_distinct(a)), share(F.filter(a, lambda x: x < tk.FIRST_ID)))


def rollout_rewards(
    logged: DataFrame,
    vocab: Vocabulary,
    weights: Sequence[float],
    bias: float = 0.0,
    *,
    key: str = "idx",
    keep: Sequence[str] = ("batch_id", "pos"),
    max_length: int = MAX_LENGTH,
    template: ChatTemplate = DEFAULT_TEMPLATE,
    mode: str = "first_line",
) -> DataFrame:
    """The whole scoring path as one plan: decode, find the post, rebuild the chat,
    encode, cut, score, default.

    The linear head ``weights`` is applied to ``id_features`` of the cut chat. A row whose chat cannot be
    rebuilt gets the default reward and is flagged. Rows are shuffled by key once; both
    decodes, the encode and the score follow in that layout when the vocabulary is small.
    """
    chats = rollout_chats(logged, vocab, key=key, keep=keep, template=template, mode=mode)
    tokens = tk.tokens("chat_text", template=template, newlines=True)
    has_chat = F.col("chat_text").isNotNull().alias("has_chat")
    coded = encode(chats.withColumn("has_chat", has_chat), vocab, key=key, tokens=tokens, keep=[*keep, "has_chat"], placed=True)
    scored = coded.select(
        key,
        *keep,
        F.when(F.col("has_chat"), F.least(F.size("input_ids"), F.lit(max_length)).cast("bigint")).alias("n_tokens"),
        F.when(F.col("has_chat"), tk.is_truncated("input_ids", max_length)).alias("truncated"),
        F.when(F.col("has_chat"), reward_score(id_features(tk.truncate("input_ids", max_length)), weights, bias)).alias("score"),
    )
    return reward_default(scored).drop("score")
