"""Queries on tokens, encoded sequences and batch plans."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F

from ..functions import tokens as tk
from ..operators import batches as bt, encode as enc
from ..operators.udf import collate_batches, map_batches
from . import inputs, sql
from .registry import query
from .sql import PAIRS, build

CHATS = (*PAIRS, "chat_tokens", "vocab", "encoded")
FILLED = (*CHATS, "padded", "filled")
MAX_LENGTH = 96
PLAN = bt.SFT_PLAN


def spaced(ids: Column | str) -> Column:
    """An id array as text, so that results compare the same in every engine."""
    a = F.col(ids) if isinstance(ids, str) else ids
    return F.array_join(a.cast("array<string>"), " ")


@query(
    "tokens",
    f"""SELECT doc_id, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS digest
    FROM (SELECT doc_id, {sql.tokens('text')} AS t FROM documents)""",
)
def q_tokens(spark, sf_dir):
    rows = inputs.table(spark, sf_dir, "documents", spread=True).select("doc_id", tk.tokens("text").alias("t"))
    return rows.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("digest"))


@query(
    "vocab",
    f"""SELECT token, row_number() OVER (ORDER BY n DESC, token) + {tk.FIRST_ID - 1} AS id, n
    FROM (SELECT token, count(*) AS n FROM (SELECT unnest({sql.tokens('text')}) AS token FROM documents) GROUP BY token)
    QUALIFY id < {inputs.VOCAB_SIZE + tk.FIRST_ID}
    UNION ALL SELECT * FROM (VALUES ('{sql.END}', {tk.PAD_ID}, 0), ('<unk>', {tk.UNK_ID}, 0), ('{sql.START}', {tk.START_ID}, 0))""",
)
def q_vocab(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents", spread=True)
    built = enc.build_vocab(enc.token_counts(docs, tk.tokens("text")), inputs.VOCAB_SIZE)
    return built.select("token", F.col("id").cast("bigint").alias("id"), "n")


@query("encode", build("SELECT idx, len(input_ids) AS n_ids, array_to_string(input_ids, ' ') AS ids FROM encoded", *CHATS))
def q_encode(spark, sf_dir):
    rows = inputs.pairs(spark, sf_dir).rows
    coded = enc.encode(rows, inputs.chat_vocab(spark, sf_dir), key="idx", tokens=inputs.chat_tokens())
    return coded.select("idx", F.size("input_ids").cast("bigint").alias("n_ids"), spaced("input_ids").alias("ids"))


@query(
    "decode",
    build(
        rf"""SELECT idx, regexp_replace(string_agg(token, ' ' ORDER BY place), ' ?\n ?', E'\n', 'g') AS text
        FROM chat_tokens WHERE token NOT IN ('{sql.START}', '{sql.END}') GROUP BY idx""",
        *PAIRS,
        "chat_tokens",
    ),
)
def q_decode(spark, sf_dir):
    return enc.decode(inputs.encoded_chats(spark, sf_dir), inputs.chat_vocab(spark, sf_dir), key="idx")


@query(
    "truncate",
    build(
        f"""SELECT idx, len(input_ids) AS n_full, array_to_string(input_ids[1:{MAX_LENGTH}], ' ') AS ids,
            len(input_ids) > {MAX_LENGTH} AS truncated FROM encoded""",
        *CHATS,
    ),
)
def q_truncate(spark, sf_dir):
    return inputs.encoded_chats(spark, sf_dir).select(
        "idx",
        F.size("input_ids").cast("bigint").alias("n_full"),
        spaced(tk.truncate("input_ids", MAX_LENGTH)).alias("ids"),
        tk.is_truncated("input_ids", MAX_LENGTH).alias("truncated"),
    )


@query(
    "prompt_budget",
    build(
        f"""SELECT idx, least(n, {MAX_LENGTH} // 2)::BIGINT AS n_kept, n > {MAX_LENGTH} // 2 AS cue_lost
        FROM (SELECT idx, sum(len({sql.IDS})) AS n FROM asked LEFT JOIN vocab USING (token) GROUP BY idx)""",
        *PAIRS,
        "chat_tokens",
        "vocab",
        "asked",
    ),
)
def q_budget(spark, sf_dir):
    logged = inputs.logged_rollouts(spark, sf_dir).select("idx", F.col("query_ids").alias("input_ids"))
    cut = enc.prompt_budget(logged, max_length=MAX_LENGTH)
    return cut.select("idx", F.size("input_ids").cast("bigint").alias("n_kept"), "cue_lost")


@query(
    "attention_mask",
    build("SELECT idx, repeat('1 ', len(input_ids) - 1) || '1' AS mask FROM encoded", *CHATS),
)
def q_mask(spark, sf_dir):
    return inputs.encoded_chats(spark, sf_dir).select("idx", spaced(tk.attention_mask(F.size("input_ids"))).alias("mask"))


@query(
    "pad_batch",
    build("SELECT idx, array_to_string(ids, ' ') AS ids, array_to_string([CASE WHEN i < n THEN 1 ELSE 0 END FOR i IN range(width)], ' ') AS mask FROM filled", *FILLED),
)
def q_pad(spark, sf_dir):
    padded = enc.pad_batch(inputs.encoded_chats(spark, sf_dir), batch=["batch_id"])
    return padded.select("idx", spaced("input_ids").alias("ids"), spaced("attention_mask").alias("mask"))


@query(
    "causal_labels",
    build(
        f"""SELECT idx, array_to_string([CASE WHEN x = {tk.PAD_ID} THEN {tk.IGNORE_LABEL} ELSE x END FOR x IN ids], ' ') AS pad_id,
            array_to_string([CASE WHEN i > n THEN {tk.IGNORE_LABEL} ELSE x END FOR x, i IN ids], ' ') AS pad_pos FROM filled""",
        *FILLED,
    ),
)
def q_labels(spark, sf_dir):
    padded = enc.pad_batch(inputs.encoded_chats(spark, sf_dir), batch=["batch_id"])
    return padded.select(
        "idx",
        spaced(tk.causal_labels("input_ids")).alias("pad_id"),
        spaced(tk.causal_labels("input_ids", mask_mode="pad_pos", mask="attention_mask")).alias("pad_pos"),
    )


@query(
    "stack_batch",
    build(
        "SELECT batch_id, count(*) AS n_rows, max(width) AS width, string_agg(array_to_string(ids, ' '), ';' ORDER BY pos) AS ids FROM filled GROUP BY batch_id",
        *FILLED,
    ),
)
def q_stack(spark, sf_dir):
    padded = enc.pad_batch(inputs.encoded_chats(spark, sf_dir), batch=["batch_id"])
    stacked = enc.stack_batch(padded, batch=["batch_id"])
    rows = F.transform("input_ids", lambda r: F.array_join(r.cast("array<string>"), " "))
    return stacked.select(
        "batch_id", "n_rows", F.size(F.col("input_ids")[0]).cast("bigint").alias("width"), F.array_join(rows, ";").alias("ids")
    )


def _text_stats(batch: pd.DataFrame) -> pd.DataFrame:
    words = batch["text"].str.count(r"[^ \n\t\r]+")
    return pd.DataFrame({"doc_id": batch["doc_id"], "n_words": words.astype("int64"), "n_lines": batch["text"].str.count("\n") + 1})


@query(
    "map_batches",
    r"""SELECT doc_id, len(regexp_extract_all(text, '[^ \n\t\r]+')) AS n_words,
        length(text) - length(replace(text, E'\n', '')) + 1 AS n_lines FROM documents""",
)
def q_map(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents", spread=True)
    return map_batches(docs, _text_stats, "doc_id BIGINT, n_words BIGINT, n_lines BIGINT", columns=["doc_id", "text"])


def _collate(rows: pd.DataFrame) -> pd.DataFrame:
    lengths = rows["input_ids"].map(len)
    return pd.DataFrame(
        {
            "batch_id": rows["batch_id"].iloc[:1],
            "n_rows": len(rows),
            "width": int(lengths.max()),
            "n_pads": int((lengths.max() - lengths).sum()),
        }
    )


@query(
    "collate_batches",
    build(
        "SELECT batch_id, count(*) AS n_rows, max(width) AS width, sum(width - n)::BIGINT AS n_pads FROM filled GROUP BY batch_id",
        *FILLED,
    ),
)
def q_collate(spark, sf_dir):
    return collate_batches(
        inputs.encoded_chats(spark, sf_dir), _collate, "batch_id BIGINT, n_rows BIGINT, width BIGINT, n_pads BIGINT",
        batch=["batch_id"], columns=["input_ids"],
    )


def _doc_keys(spark, sf_dir):
    return inputs.table(spark, sf_dir, "documents").select("doc_id")


def _planned(spark, sf_dir):
    return bt.plan_batches(_doc_keys(spark, sf_dir), key="doc_id", plan=PLAN)


def _groups(spark, sf_dir):
    return bt.accum_groups(bt.batches_of(_planned(spark, sf_dir)), PLAN.accumulation)


def _steps(spark, sf_dir):
    rows = _doc_keys(spark, sf_dir).count()
    stepped = bt.global_step(_groups(spark, sf_dir), steps_per_epoch=PLAN.steps_per_epoch(rows))
    return bt.epoch_progress(stepped, batches_per_epoch=PLAN.batches(rows), accumulation=PLAN.accumulation)


@query("epoch_expand", "SELECT doc_id, unnest(range(3))::INT AS epoch FROM documents")
def q_expand(spark, sf_dir):
    return bt.epoch_expand(_doc_keys(spark, sf_dir), PLAN.epochs)


@query("epoch_shuffle", build("SELECT doc_id, epoch, idx FROM shuffled", "shuffled"))
def q_shuffle(spark, sf_dir):
    expanded = bt.epoch_expand(_doc_keys(spark, sf_dir), PLAN.epochs)
    return bt.epoch_shuffle(expanded, key="doc_id", seed=PLAN.seed)


@query("eval_order", "SELECT doc_id, row_number() OVER (ORDER BY source, doc_id) - 1 AS idx FROM documents")
def q_eval_order(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", "source")
    return bt.eval_order(docs, key=["source", "doc_id"]).select("doc_id", "idx")


@query("batch_ids", build("SELECT doc_id, epoch, idx // 4 AS batch_id, idx % 4 AS pos FROM shuffled", "shuffled"))
def q_batches(spark, sf_dir):
    return _planned(spark, sf_dir).select("doc_id", "epoch", "batch_id", "pos")


@query("accum_groups", build("SELECT epoch, batch_id, n_rows, accum_group FROM groups", "shuffled", "batches", "groups"))
def q_groups(spark, sf_dir):
    return _groups(spark, sf_dir)


STEPS = ("shuffled", "batches", "groups", "steps")


@query("global_step", build("SELECT epoch, batch_id, accum_group, global_step FROM steps", *STEPS))
def q_global(spark, sf_dir):
    return _steps(spark, sf_dir).select("epoch", "batch_id", "accum_group", "global_step")


@query(
    "cadence",
    build(
        """SELECT DISTINCT global_step, global_step % 10 = 0 AS log_due, global_step % 50 = 0 AS eval_due,
            global_step % 200 = 0 AND global_step > 0 AS save_due FROM steps""",
        *STEPS,
    ),
)
def q_cadence(spark, sf_dir):
    steps = _steps(spark, sf_dir).filter(F.col("batch_id") % PLAN.accumulation == PLAN.accumulation - 1)
    events = {"log_due": 10, "eval_due": 50, "save_due": 200}
    return bt.cadence(steps.select("global_step"), every=events, skip_zero=["save_due"])


@query("step_cap", build("SELECT epoch, batch_id, n_rows FROM batches WHERE batch_id < 500", "shuffled", "batches"))
def q_cap(spark, sf_dir):
    return bt.batches_of(bt.step_cap(_planned(spark, sf_dir)))


@query(
    "step_plan",
    """SELECT lang, n_rows, batches, batches // 24 AS steps_per_epoch, batches // 24 * 3 AS steps, batches * 3 // 24 AS planned_steps,
        batches % 24 AS unused_batches, 96::BIGINT AS effective_batch
    FROM (SELECT lang, count(*) AS n_rows, (count(*) + 3) // 4 AS batches FROM documents GROUP BY lang)""",
)
def q_step_plan(spark, sf_dir):
    return bt.step_plan(inputs.table(spark, sf_dir, "documents"), PLAN, by=["lang"])


@query(
    "epoch_progress",
    build(
        """SELECT DISTINCT global_step, round(epoch + ((accum_group + 1) * 24) / batches_per_epoch::DOUBLE, 6) AS epoch_progress
        FROM steps""",
        *STEPS,
    ),
)
def q_progress(spark, sf_dir):
    steps = _steps(spark, sf_dir).filter(F.col("batch_id") % PLAN.accumulation == PLAN.accumulation - 1)
    return steps.select("global_step", F.round("epoch_progress", 6).alias("epoch_progress"))
