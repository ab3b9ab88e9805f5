"""Vocabulary, encoding to ids, decoding, padding and stacking."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import tokens as tk
from ..functions.chat import ChatTemplate, DEFAULT_TEMPLATE
from ..session import store
from .joins import fits_broadcast, lookup
from .rowindex import row_index


@dataclass(frozen=True)
class Vocabulary:
    """A stored table (token, id, n), whether it was measured to fit a broadcast, and, if so and its ids can be
    places of an array, the largest id."""

    table: DataFrame
    small: bool
    top: int | None = None

    @classmethod
    def stored(cls, table: DataFrame) -> Vocabulary:
        written = store(table, "vocabulary")
        small = fits_broadcast(written)
        return cls(written, small, _top(written) if small else None)


def _top(table: DataFrame) -> int | None:
    """The largest id, when no two tokens share one and none is far beyond their number."""
    ids = F.col("id")
    row = table.agg(F.min(ids).alias("low"), F.max(ids).alias("top"), F.count(ids).alias("n"), F.count_distinct(ids).alias("distinct")).first()
    fits = row["n"] and row["low"] >= 0 and row["n"] == row["distinct"] and row["top"] <= 2 * row["n"] + tk.FIRST_ID
    return row["top"] if fits else None


def token_counts(df: DataFrame, tokens: Column) -> DataFrame:
    return df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def build_vocab(counts: DataFrame, size: int, *, template: ChatTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """The ``size`` most frequent tokens with ids by (count desc, token), reserved ids first.

    The order comes from a range sort over all tokens; no single task merges the
    per-task tops, so ``size`` may be large.
    """
    reserved = tk.reserved_tokens(template)
    ranked = row_index(
        counts.filter(~F.col("token").isin(*reserved)), [F.desc("n"), F.col("token")], name="rank"
    )
    kept = ranked.filter(F.col("rank") < size).select(
        "token", (F.col("rank") + tk.FIRST_ID).cast("int").alias("id"), "n"
    )
    fixed = ",".join(f"('{t}', {i}, {0}L)" for t, i in reserved.items())
    return kept.unionByName(counts.sparkSession.sql(f"SELECT * FROM VALUES {fixed} AS v(token, id, n)"))


def encode(
    df: DataFrame,
    vocab: Vocabulary,
    *,
    key: str,
    tokens: Column,
    keep: Sequence[str] = (),
    out: str = "input_ids",
    placed: bool = False,
) -> DataFrame:
    """Token arrays to id arrays: (key, keep..., out). A token outside the vocabulary becomes
    its byte pieces, so nothing is lost: ``decode`` gives every token back.

    ``key`` must be unique. Texts are shuffled once by key, before they are cut
    into tokens, so the per-token rows are joined and gathered inside one stage. A
    small vocabulary is broadcast; with a larger one the frequent tokens are
    split off. ``placed`` says that the rows already lie by key.
    """
    keep = list(keep)
    rows = df.repartition(key) if vocab.small and not placed else df
    rows = rows.select(key, *keep, tokens.alias("__tokens"))
    exploded = rows.select(key, *keep, F.posexplode_outer("__tokens").alias("__pos", "__token"))
    coded = _translate(exploded, vocab, "__token", "__id", key)
    # words outside the vocabulary are cut into pieces when they are at their place
    word = F.when(F.col("__id").isNull(), F.col("__token"))
    item = F.when(F.col("__token").isNotNull(), F.struct("__pos", "__id", word.alias("word")))
    gathered = coded.groupBy(key, *keep).agg(F.sort_array(F.collect_list(item)).alias("__items"))
    pieces = F.transform("__items", lambda m: F.coalesce(F.when(m["__id"].isNotNull(), F.array(m["__id"])), tk.byte_pieces(m["word"])))
    return gathered.select(key, *keep, F.flatten(pieces).alias(out))


def _translate(exploded: DataFrame, vocab: Vocabulary, given: str, wanted: str, key: str) -> DataFrame:
    """``exploded`` with the vocabulary's ``wanted`` column for its ``given`` one.

    Which values are frequent is counted on the rows at hand, known or not: the
    vocabulary may come from other texts.
    """
    pairs = vocab.table.select(F.col("token").alias("__token"), F.col("id").alias("__id"))
    if vocab.small:
        return exploded.join(F.broadcast(pairs), given, "left")
    used = exploded.filter(F.col(given).isNotNull()).groupBy(given).agg(F.count(F.lit(1)).alias("__n"))
    table = store(used.join(pairs, given, "left").select(given, wanted, "__n"), "translation")
    return lookup(exploded, table, [given], weight="__n", spread=[key, "__pos"])


def decode(
    df: DataFrame,
    vocab: Vocabulary,
    *,
    key: str,
    ids: str = "input_ids",
    keep: Sequence[str] = (),
    out: str = "text",
) -> DataFrame:
    """Id arrays to text: reserved ids dropped, byte pieces put together, tokens joined by a blank, line breaks kept.

    A cut through a word leaves the bytes before it; a cut character becomes the replacement character.
    """
    return decode_columns(df, vocab, {ids: out}, key=key, keep=keep)


def decode_columns(df: DataFrame, vocab: Vocabulary, columns: dict[str, str], *, key: str, keep: Sequence[str] = ()) -> DataFrame:
    """``decode`` of several id columns at once.

    With a small vocabulary the parts of all ids go to the tasks as one array, in which an id is a place, and each row is decoded
    where it lies, shuffled by key. Otherwise all ids go through one explode, one translation and one regroup by key.
    """
    keep = list(keep)
    rows = df.repartition(key) if vocab.small else df
    if vocab.top is not None:
        # 0 for every key, as an equal key makes it a hash join
        told = rows.withColumn("__one", F.pmod(F.xxhash64(key), F.lit(1))).join(F.broadcast(_parts(vocab)), "__one")

        last = max(vocab.top, tk.FIRST_ID - 1)

        def own(c: str) -> Column:
            ids = F.filter(c, lambda x: (x >= tk.FIRST_BYTE) & (x <= last))
            return F.transform(ids, lambda x: F.get("__parts", x.cast("int")))

        return told.select(key, *keep, *[_joined(own(c)).alias(k) for c, k in columns.items()])
    sides = F.array(*[F.struct(F.lit(k).alias("side"), F.filter(c, lambda x: x >= tk.FIRST_BYTE).alias("ids")) for k, c in enumerate(columns)])
    each = rows.select(key, *keep, F.explode(sides).alias("s")).select(key, *keep, F.col("s.side").alias("__side"), F.posexplode_outer("s.ids").alias("__pos", "__id"))
    named = _translate(each, vocab, "__id", "__token", key)
    part = tk.decoded_part("__id", "__token")
    item = F.when(part.isNotNull(), F.struct("__side", "__pos", part.alias("part")))
    gathered = named.groupBy(key, *keep).agg(F.array_sort(F.collect_list(item)).alias("__items"))

    def side(k: int) -> Column:
        return F.transform(F.filter("__items", lambda m: m["__side"] == k), lambda m: m["part"])

    return gathered.select(key, *keep, *[_joined(side(k)).alias(c) for k, c in enumerate(columns.values())])


def _parts(vocab: Vocabulary) -> DataFrame:
    """One written row, with __one = 0: the array of what each id from 0 to the largest adds to a decoded text, NULL for nothing."""
    spark = vocab.table.sparkSession
    ids = spark.range(max(vocab.top + 1, tk.FIRST_ID)).select(F.col("id").cast("int").alias("id"))
    part = tk.decoded_part("id", "token").alias("part")
    each = ids.join(F.broadcast(vocab.table.select("id", "token")), "id", "left").select("id", part)
    placed = each.agg(F.array_sort(F.collect_list(F.struct("id", "part"))).alias("items"))
    return store(placed.select(F.lit(0).cast("bigint").alias("__one"), F.transform("items", lambda m: m["part"]).alias("__parts")), "decoded-parts")


def _joined(parts: Column) -> Column:
    """The text of decoded parts; NULL ones, and a NULL array, add nothing."""
    raw = F.make_valid_utf8(F.unhex(F.coalesce(F.array_join(parts, ""), F.lit(""))).cast("string"))
    return F.regexp_replace(F.substring(raw, 2, 2**31 - 1), " ?\\n ?", "\n")


def pad_batch(
    df: DataFrame, *, batch: Sequence[str], columns: Sequence[str] = ("input_ids",), pad_id: int = tk.PAD_ID
) -> DataFrame:
    """Pad each id column to its longest row in the batch and add its mask.

    A batch holds at most batch-size rows, so the window never grows with the table.
    """
    w = Window.partitionBy(*batch)
    for c in columns:
        width = f"__width_{c}"
        df = df.withColumn(width, F.max(F.size(c)).over(w))
    for c in columns:
        width = F.col(f"__width_{c}")
        mask = tk.attention_mask(F.size(c), width)
        df = df.withColumn(mask_name(c), mask).withColumn(c, tk.pad_to(c, width, pad_id))
    return df.drop(*[f"__width_{c}" for c in columns])


def mask_name(ids: str) -> str:
    return ids.replace("input_ids", "attention_mask") if "input_ids" in ids else f"{ids}_mask"


def stack_batch(
    df: DataFrame, *, batch: Sequence[str] = ("epoch", "batch_id"), pos: str = "pos", columns: Sequence[str] = ("input_ids",)
) -> DataFrame:
    """One row per batch with its sequences as a matrix per column, in ``pos`` order.

    Fails when the rows of a batch differ in length.
    """
    item = F.struct(pos, *columns)
    grouped = df.groupBy(*batch).agg(
        F.array_sort(F.collect_list(item)).alias("__rows"),
        *[F.min(F.size(c)).alias(f"__min_{c}") for c in columns],
        *[F.max(F.size(c)).alias(f"__max_{c}") for c in columns],
    )
    def matrix(c: str) -> Column:
        stacked = F.transform("__rows", lambda r: r[c])
        ragged = F.raise_error(F.lit(f"rows of a batch differ in length: {c}"))
        return F.when(F.col(f"__min_{c}") == F.col(f"__max_{c}"), stacked).otherwise(ragged).alias(c)

    return grouped.select(
        *batch, F.size("__rows").cast("bigint").alias("n_rows"), *[matrix(c) for c in columns]
    )


def prompt_budget(df: DataFrame, *, ids: str = "input_ids", max_length: int, cue_tokens: int = 2) -> DataFrame:
    """Cut prompts to half of ``max_length`` and flag those that lost the assistant cue."""
    half = max_length // 2
    return df.withColumn("cue_lost", (F.size(ids) > half) & F.lit(cue_tokens > 0)).withColumn(
        ids, tk.truncate(ids, half)
    )


def truncate_prompt_first(
    df: DataFrame, *, max_length: int, head: str = "head_ids", post: str = "post_ids", tail: str = "tail_ids", out: str = "input_ids"
) -> DataFrame:
    """Shorten the post, never the response: head + as much post as fits + tail.

    The other order (render, then cut from the right) can lose the response; this
    one cuts the tail only when head and tail alone are too long.
    """
    room = F.greatest(F.lit(0), F.lit(max_length) - F.size(head) - F.size(tail))
    whole = F.concat(F.col(head), F.slice(F.col(post), F.lit(1), room), F.col(tail))
    total = F.size(head) + F.size(post) + F.size(tail)
    return df.withColumn(out, F.slice(whole, 1, max_length)).withColumn("truncated", total > max_length)
