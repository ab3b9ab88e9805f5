"""Comparison rows and conversation turns to rendered chats."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.chat import ChatTemplate, DEFAULT_TEMPLATE, chat_array
from ..functions.numeric import idiv

SEGMENT_TURNS = 64


def render_sft(df: DataFrame, *, keep: tuple[str, ...] = ("idx",), template: ChatTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """prompt + chosen as one chat text; the raw columns are dropped."""
    return df.select(*keep, template.render(chat_array("prompt", "chosen")).alias("text"))


def render_prompts(df: DataFrame, *, keep: tuple[str, ...] = ("idx",), template: ChatTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """Prompt-only chat text that ends with the assistant cue."""
    return df.select(*keep, template.render(chat_array("prompt"), add_cue=True).alias("query"))


def render_pairs(df: DataFrame, *, keep: tuple[str, ...] = ("idx",), template: ChatTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """The same prompt rendered twice, with the chosen and with the rejected answer."""
    return df.select(
        *keep,
        template.render(chat_array("prompt", "chosen")).alias("chosen_text"),
        template.render(chat_array("prompt", "rejected")).alias("rejected_text"),
    )


def render_conversations(
    turns: DataFrame,
    *,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    segment_turns: int = SEGMENT_TURNS,
    segments: bool = False,
    template: ChatTemplate = DEFAULT_TEMPLATE,
) -> DataFrame:
    """Chats stored as one row per turn, rendered in turn order: one row per conversation.

    Turns are put together by segments of ``segment_turns`` turn numbers first, so a long chat is
    rendered by many tasks, and the few segments of a conversation then give its text. With ``segments``
    the segments themselves are returned, for a caller that cannot hold a whole chat in a row.
    """
    rendered = template.turn(F.col(role), F.col(text))
    parts = (
        turns.select(key, idiv(turn, segment_turns).alias("segment"), F.struct(F.col(turn).alias("t"), rendered.alias("x")).alias("m"))
        .groupBy(key, "segment")
        .agg(F.array_sort(F.collect_list("m")).alias("ms"))
        .select(
            key,
            "segment",
            F.size("ms").cast("bigint").alias("n_turns"),
            F.array_join(F.transform("ms", lambda m: m["x"]), "").alias("text"),
        )
    )
    if segments:
        return parts
    whole = parts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("segment", "text"))).alias("ps"), F.sum("n_turns").alias("n_turns"))
    return whole.select(key, "n_turns", F.array_join(F.transform("ps", lambda p: p["text"]), "").alias("text"))
