"""Comparison, rollout and run tables derived from the given tables.

Tables that several queries read and that need a row order are written once per
session and folder, as a real job would prepare them; the rest are projections.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import tokens as tk
from ..functions.chat import DEFAULT_TEMPLATE, INSTRUCTION, chat_array
from ..functions.numeric import idiv
from ..operators import encode as enc
from ..operators.joins import attach, lookup
from ..operators.models import BigramModel, lm_fit, text_features, text_nll
from ..operators.rowindex import indexed, row_index
from ..operators.scoring import score_table
from ..operators.splits import StagePlan
from ..session import fill_cores, new_path, store, temporary

WEIGHTS = [((i * 7) % 11 - 5) / 10 for i in range(64)]
CHAT_WEIGHTS = (0.5, -1.25, 2.0)
ROLLOUT_BATCH = 8
EPOCH_BATCHES = 500
STATE_ROWS = 16
VOCAB_SIZE = 2000

_PREPARED: dict[tuple, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str, *, spread: bool = False) -> DataFrame:
    """A given table. ``spread`` is for heavy work per row: see ``fill_cores``."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return fill_cores(df) if spread else df


def _state(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of all files below a folder, partition folders included."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    out = []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """What ``make`` gives, made again only when the session or the files of the folder have changed."""
    key = (spark.sparkContext.applicationId, _state(spark, str(sf_dir)), name)
    if key not in _PREPARED:
        _PREPARED[key] = make()
    return _PREPARED[key]


@dataclass(frozen=True)
class Prepared:
    """A written table: where it is and how many rows it has."""

    path: str
    rows: DataFrame
    count: int
    train_count: int = 0


def build_pairs(spark: SparkSession, sf_dir: str) -> Prepared:
    """Comparisons from conversations: a user turn, its reply, and the next pair's reply.

    Everything about order is worked out on keys. "Next turn" is the next row in
    (conv_id, turn) order, found by an equi-join on the row position; a window per
    conversation would put a very long one in a single task. Texts come last: one
    join by turn, then three texts per pair are gathered.
    """
    source = table(spark, sf_dir, "conversations")
    turns = row_index(source.select("conv_id", "turn", "role"), ["conv_id", "turn"], name="at")
    replies = turns.filter("role = 'assistant'").select(
        (F.col("at") - 1).alias("at"), F.col("conv_id").alias("next_conv"), F.col("turn").alias("reply")
    )
    keys = (
        turns.filter("role = 'user'")
        .join(replies, "at")
        .filter("conv_id = next_conv")
        .select("conv_id", "turn", "reply", F.when(F.col("conv_id") % 10 == 9, "valid1").otherwise("train").alias("split"))
    )
    numbered, n = indexed(keys, ["conv_id", "turn"])
    placed = row_index(numbered, ["idx"], partition_by=["split"], name="split_pos")
    others = placed.select(
        F.pmod(F.col("idx") - 1, F.lit(max(n, 1))).alias("idx"), F.col("conv_id").alias("other_conv"), F.col("reply").alias("other_reply")
    )

    def ref(slot: str, conv: str, turn: str) -> Column:
        return F.struct(F.lit(slot).alias("slot"), F.col(conv).alias("c"), F.col(turn).alias("t"))

    slots = F.array(ref("prompt", "conv_id", "turn"), ref("chosen", "conv_id", "reply"), ref("rejected", "other_conv", "other_reply"))
    own = ["idx", "conv_id", "turn", "split_pos", "split"]
    refs = placed.join(others, "idx").select(*own, F.explode(slots).alias("r")).select(*own, "r.*")
    texts = source.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), "text")
    gathered = (
        refs.join(texts, ["c", "t"])
        .groupBy(*own)
        .agg(*[F.max(F.when(F.col("slot") == s, F.col("text"))).alias(s) for s in ("prompt", "chosen", "rejected")])
        .select("idx", "conv_id", "turn", "prompt", "chosen", "rejected", "split_pos", "split")
    )
    path = new_path(spark, "comparisons")
    # sorted by split and position: a slice opens only the files and row groups of its range
    gathered.repartitionByRange("split", "split_pos").sortWithinPartitions("split", "split_pos").write.partitionBy("split").parquet(path)
    rows = spark.read.schema(gathered.schema).parquet(path)
    return Prepared(path, rows, n, rows.filter("split = 'train'").count())


def pairs(spark: SparkSession, sf_dir: str) -> Prepared:
    return _once(spark, sf_dir, "pairs", lambda: build_pairs(spark, sf_dir))


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The train split with ``idx`` as its own position (what the stage plan counts)."""
    rows = pairs(spark, sf_dir).rows.filter("split = 'train'")
    return rows.withColumn("idx", F.col("split_pos")).drop("split_pos")


def stage_plan(spark: SparkSession, sf_dir: str) -> StagePlan:
    return StagePlan.scaled(pairs(spark, sf_dir).train_count)


def placed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts and responses at their place in batches of ROLLOUT_BATCH."""
    return pairs(spark, sf_dir).rows.select(
        "idx",
        idiv("idx", ROLLOUT_BATCH).alias("batch_id"),
        (F.col("idx") % ROLLOUT_BATCH).alias("pos"),
        "prompt",
        F.col("chosen").alias("response"),
    )


def feature_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, score): each vector is reduced to its reward before any join."""
    return score_table(table(spark, sf_dir, "embeddings"), key="vec_id", feature="embedding", weights=WEIGHTS)


def rollout_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollouts with the score of their feature; some positions have no feature and no score."""
    rows = placed_pairs(spark, sf_dir).withColumn("vec_id", F.col("idx") * 3)
    return rows.join(feature_scores(spark, sf_dir), "vec_id", "left").drop("vec_id")


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of at most STATE_ROWS hidden states, masks ending seq_id % 5 places early."""
    e = table(spark, sf_dir, "embeddings")
    item = F.struct("vec_id", "embedding")
    seqs = e.groupBy(idiv("vec_id", STATE_ROWS).alias("seq_id")).agg(F.array_sort(F.collect_list(item)).alias("s"))
    real = F.greatest(F.lit(0), F.size("s") - (F.col("seq_id") % 5).cast("int"))
    return seqs.select(
        "seq_id",
        F.transform("s", lambda x: x["embedding"]).alias("states"),
        tk.attention_mask(real, F.size("s")).alias("mask"),
    )


def run_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batch losses: each event type is a run, events in time order are its batches."""

    def make() -> DataFrame:
        events = table(spark, sf_dir, "events").select(F.col("event_type").alias("run"), "ts", "event_id", F.col("value").alias("loss"))
        return row_index(events, ["ts", "event_id"], partition_by=["run"], name="m")

    steps = _once(spark, sf_dir, "run_steps", make)
    return steps.select("run", "m", idiv("m", EPOCH_BATCHES).alias("epoch"), (F.col("m") % EPOCH_BATCHES).alias("batch_id"), "loss")


def eval_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every step of each run with its loss as eval loss."""
    return run_steps(spark, sf_dir).select("run", (F.col("m") + 1).alias("step"), F.col("loss").alias("eval_loss"))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "conversations")
        .filter("role = 'assistant'")
        .select(
            F.col("conv_id").alias("prompt_id"),
            F.col("turn").alias("cand_id"),
            F.col("text").alias("response"),
            F.log(F.lit(1.0) + F.length("text")).alias("logit"),
        )
    )


def doc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good documents paired round-robin with bad ones of their language, as id pairs.

    Ids only: what a job needs of the texts (features, scores) is worked out per
    document and joined as numbers.
    """

    return _once(spark, sf_dir, "doc_pairs", lambda: store(build_doc_pairs(spark, sf_dir), "doc-pairs"))


def build_doc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    ranked = row_index(docs.join(labels, "doc_id"), ["doc_id"], partition_by=["lang", "quality"], name="r")
    sizes = ranked.groupBy("lang").agg(
        F.sum(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("n_good"),
        F.sum(F.when(F.col("quality") == 0, 1).otherwise(0)).alias("n_bad"),
    )
    good = ranked.filter("quality = 1").select("lang", "r", F.col("doc_id").alias("chosen_id"))
    bad = ranked.filter("quality = 0").select("lang", "r", F.col("doc_id").alias("rejected_id"))
    good = attach(good, sizes.filter("n_bad > 0").select("lang", "n_good", "n_bad"), ["lang"], weight="n_good", spread=["chosen_id"], how="inner")
    good = good.withColumn("r", F.col("r") % F.col("n_bad")).drop("n_bad")
    uses = sizes.filter("n_bad > 0").select("lang", "n_bad", (F.col("n_good") / F.col("n_bad")).alias("uses"))
    bad = attach(bad, uses, ["lang"], weight="n_bad", spread=["rejected_id"])
    return attach(good, bad, ["lang", "r"], weight="uses", spread=["chosen_id"], how="inner").drop("r")


def featured_doc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document pairs with both sides' text features (worked out once per document)."""

    def features() -> DataFrame:
        labelled = table(spark, sf_dir, "labels").select("doc_id")
        docs = table(spark, sf_dir, "documents", spread=True).join(labelled, "doc_id", "left_semi")
        return store(docs.select("doc_id", text_features("text").alias("feature")), "doc-features")

    def joined() -> DataFrame:
        ids = doc_pairs(spark, sf_dir).select("lang", "chosen_id", "rejected_id")
        feats = features()
        uses = ids.groupBy("rejected_id").agg(F.count(F.lit(1)).alias("uses"))
        good = feats.select(F.col("doc_id").alias("chosen_id"), F.col("feature").alias("chosen_feature"))
        bad = feats.select(F.col("doc_id").alias("rejected_id"), F.col("feature").alias("rejected_feature"))
        bad = store(bad.join(uses, "rejected_id"), "rejected-features")
        return store(lookup(ids.join(good, "chosen_id"), bad, ["rejected_id"], weight="uses", spread=["chosen_id"], how="inner"), "featured-pairs")

    return _once(spark, sf_dir, "featured_doc_pairs", joined)


def chat_vocab(spark: SparkSession, sf_dir: str) -> enc.Vocabulary:
    """Vocabulary of rendered SFT chats; markers and line breaks are tokens."""

    def make() -> enc.Vocabulary:
        counts = enc.token_counts(pairs(spark, sf_dir).rows, chat_tokens())
        return enc.Vocabulary.stored(enc.build_vocab(counts, VOCAB_SIZE))

    return _once(spark, sf_dir, "chat_vocab", make)


def lm_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", spread=True).select("doc_id", "text", "lang")


def is_fit_part() -> Column:
    """Documents that language models learn from; the others are held out."""
    return F.col("doc_id") % 10 < 8


def fit_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_documents(spark, sf_dir).filter(is_fit_part())


def reference_lm(spark: SparkSession, sf_dir: str) -> BigramModel:
    """Fitted on all documents of the fit part."""
    return _once(spark, sf_dir, "reference_lm", lambda: lm_fit(fit_documents(spark, sf_dir), key="doc_id"))


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under both models, scored and written once: (doc_id, n_tokens, policy, reference)."""

    def make() -> DataFrame:
        both = {"policy": policy_lm(spark, sf_dir), "reference": reference_lm(spark, sf_dir)}
        with temporary("lm-scores"):
            return store(text_nll(lm_documents(spark, sf_dir), both, key="doc_id"), "lm-scores")

    return _once(spark, sf_dir, "lm_scores", make)


def policy_lm(spark: SparkSession, sf_dir: str) -> BigramModel:
    """Fitted on the documents of the fit part with a good label."""

    def make() -> BigramModel:
        good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
        docs = fit_documents(spark, sf_dir).join(good, "doc_id", "left_semi")
        return lm_fit(docs, key="doc_id")

    return _once(spark, sf_dir, "policy_lm", make)


def chat_tokens(prompt: str = "prompt", answer: str | None = "chosen") -> Column:
    """Tokens of a rendered chat; without ``answer`` it ends with the assistant cue."""
    text = DEFAULT_TEMPLATE.render(chat_array(prompt, answer), add_cue=answer is None)
    return tk.tokens(text, template=DEFAULT_TEMPLATE, newlines=True)


def encoded_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SFT chats as ids, written once because every epoch reads them: (idx, batch_id, pos, input_ids)."""

    def make() -> DataFrame:
        rows = pairs(spark, sf_dir).rows
        coded = enc.encode(rows, chat_vocab(spark, sf_dir), key="idx", tokens=chat_tokens())
        return store(coded, "encoded-chats")

    coded = _once(spark, sf_dir, "encoded_chats", make)
    return coded.select("idx", idiv("idx", ROLLOUT_BATCH).alias("batch_id"), (F.col("idx") % ROLLOUT_BATCH).alias("pos"), "input_ids")


def logged_query() -> Column:
    """The query text of a rollout. In every fifth the line break after the instruction is lost, so its post cannot be found."""
    text = DEFAULT_TEMPLATE.render(chat_array("prompt"), add_cue=True)
    return F.when(F.col("idx") % 5 == 4, F.replace(text, F.lit(f"{INSTRUCTION}\n"), F.lit(f"{INSTRUCTION} "))).otherwise(text)


def logged_rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollouts as a policy run logs them: query and response ids per (batch_id, pos)."""

    def make() -> DataFrame:
        vocab = chat_vocab(spark, sf_dir)
        rows = placed_pairs(spark, sf_dir)
        asked = tk.tokens(logged_query(), template=DEFAULT_TEMPLATE, newlines=True)
        q = enc.encode(rows, vocab, key="idx", tokens=asked, keep=["batch_id", "pos"], out="query_ids")
        r = enc.encode(rows, vocab, key="idx", tokens=tk.tokens("response", newlines=True), out="response_ids")
        return store(q.join(r, "idx"), "logged-rollouts")

    return _once(spark, sf_dir, "logged_rollouts", make)
