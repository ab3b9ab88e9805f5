"""Queries on rewards, metrics, stage models, side files and live metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.chat import DECODED_INSTRUCTION
from ..functions.numeric import idiv
from ..functions.tokens import FIRST_ID
from ..operators import best, metrics, models, sampling, scoring
from ..operators.components import component_split
from ..operators.splits import DEFAULT_PLAN
from ..session import new_path, store
from ..sources import ledger, manifests, runlog
from ..streaming import best as live_best, live
from . import inputs, sql
from .registry import query
from .sql import PAIRS, build

GA = 24
SAMPLING = sampling.SamplingConfig(top_k=3)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(
    "last_token",
    build(
        """SELECT seq_id, last_pos, round(states[last_pos + 1][1]::DOUBLE, 6) AS first_value,
            round(list_sum([x::DOUBLE FOR x IN states[last_pos + 1]]), 6) AS total
        FROM (SELECT seq_id, states, last_pos FROM states)""",
        "states",
    ),
)
def q_last(spark, sf_dir):
    rows = inputs.states(spark, sf_dir).select(
        "seq_id", scoring.last_position("mask").cast("bigint").alias("last_pos"), scoring.last_token("states", "mask").alias("h")
    )
    total = F.aggregate("h", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return rows.select("seq_id", "last_pos", F.round(F.col("h")[0].cast("double"), 6).alias("first_value"), F.round(total, 6).alias("total"))


@query("reward_score", build("SELECT vec_id, round(score, 6) AS score FROM scores", "scores"))
def q_score(spark, sf_dir):
    return rounded(inputs.feature_scores(spark, sf_dir), "score")


def _scored_pairs(spark, sf_dir) -> DataFrame:
    ids = inputs.pairs(spark, sf_dir).rows.select(
        "idx",
        idiv("idx", inputs.ROLLOUT_BATCH).alias("batch_id"),
        (F.col("idx") * 2).alias("chosen_id"),
        (F.col("idx") * 2 + 1).alias("rejected_id"),
    )
    return scoring.score_pairs(ids, inputs.feature_scores(spark, sf_dir), key="vec_id", unique=True)


SCORED = (*PAIRS, "scores", "scored_pairs")


@query("score_pairs", build("SELECT idx, round(chosen_score, 6) AS chosen_score, round(rejected_score, 6) AS rejected_score FROM scored_pairs", *SCORED))
def q_score_pairs(spark, sf_dir):
    return rounded(_scored_pairs(spark, sf_dir).select("idx", "chosen_score", "rejected_score"), "chosen_score", "rejected_score")


@query("ranking_loss", build(f"SELECT batch_id, count(*) AS n_pairs, round(avg({sql.softplus('rejected_score - chosen_score')}), 6) AS loss FROM scored_pairs GROUP BY batch_id", *SCORED))
def q_loss(spark, sf_dir):
    return rounded(metrics.pair_metrics(_scored_pairs(spark, sf_dir), by=["batch_id"]).select("batch_id", "n_pairs", "loss"), "loss")


@query(
    "pair_accuracy",
    build(
        """SELECT batch_id, round(avg(CASE WHEN chosen_score > rejected_score THEN 1.0::DOUBLE
            WHEN chosen_score <= rejected_score THEN 0.0::DOUBLE END), 6) AS accuracy FROM scored_pairs GROUP BY batch_id""",
        *SCORED,
    ),
)
def q_accuracy(spark, sf_dir):
    return rounded(metrics.pair_metrics(_scored_pairs(spark, sf_dir), by=["batch_id"]).select("batch_id", "accuracy"), "accuracy")


@query(
    "pair_reward_means",
    build(
        """SELECT batch_id // 4 AS accum_group, round(avg(CASE WHEN batch_id % 4 = 3 THEN chosen_score END), 6) AS chosen_reward_mean,
            round(avg(CASE WHEN batch_id % 4 = 3 THEN rejected_score END), 6) AS rejected_reward_mean
        FROM scored_pairs GROUP BY 1 HAVING count(DISTINCT batch_id) = 4""",
        *SCORED,
    ),
)
def q_means(spark, sf_dir):
    stepped = metrics.step_pair_metrics(_scored_pairs(spark, sf_dir), accumulation=4)
    return rounded(stepped.select("accum_group", "chosen_reward_mean", "rejected_reward_mean"), "chosen_reward_mean", "rejected_reward_mean")


def _rewards(spark, sf_dir) -> DataFrame:
    return scoring.reward_default(inputs.rollout_scores(spark, sf_dir)).select("idx", "batch_id", "pos", "reward", "defaulted")


sql.CTES["rewards"] = f"SELECT *, coalesce({sql.score('feature')}, 0.0::DOUBLE) AS reward, feature IS NULL AS defaulted FROM rollouts"
ROLLOUTS = (*PAIRS, "rollouts", "rewards")


@query("reward_default", build("SELECT idx, round(reward, 6) AS reward, defaulted FROM rewards", *ROLLOUTS))
def q_default(spark, sf_dir):
    return rounded(_rewards(spark, sf_dir).select("idx", "reward", "defaulted"), "reward")


@query("rollout_join", build("SELECT batch_id, pos, prompt, response FROM rollouts WHERE feature IS NOT NULL", *PAIRS, "rollouts"))
def q_join(spark, sf_dir):
    queries = inputs.placed_pairs(spark, sf_dir).select("batch_id", "pos", "prompt")
    answered = inputs.rollout_scores(spark, sf_dir).filter("score IS NOT NULL").select("batch_id", "pos", "response")
    return scoring.rollout_join(queries, answered)


sql.CTES["answered"] = f"""SELECT idx, unnest(t) AS token, generate_subscripts(t, 1) AS place
    FROM (SELECT idx, {sql.tokens('chosen', sql.LINES)} AS t FROM pairs)"""
DECODED = rf"""SELECT idx, regexp_replace(coalesce(string_agg(token, ' ' ORDER BY place) FILTER (WHERE token NOT IN ('{sql.START}', '{sql.END}')), ''),
        ' ?\n ?', E'\n', 'g') AS text
    FROM {{source}} GROUP BY idx"""
sql.CTES["query_text"] = DECODED.format(source="asked")
sql.CTES["response_text"] = DECODED.format(source="answered")
_MARK = sql.text(DECODED_INSTRUCTION)
_MARK_LINE = sql.text(f"{DECODED_INSTRUCTION}\n")
sql.CTES["posts"] = f"""SELECT idx, r.text AS response, CASE
        WHEN contains(q.text, {_MARK_LINE}) THEN split_part(split_part(q.text, {_MARK_LINE}, 2), E'\\n', 1)
        WHEN contains(q.text, {_MARK}) THEN NULL ELSE q.text END AS post
    FROM query_text q JOIN response_text r USING (idx)"""
sql.CTES["rebuilt"] = f"""SELECT idx, flatten(list({sql.IDS} ORDER BY place)) AS ids FROM (
        SELECT idx, unnest(t) AS token, generate_subscripts(t, 1) AS place
        FROM (SELECT idx, {sql.tokens(sql.chat('post', 'response'), sql.MARKED)} AS t FROM posts WHERE post IS NOT NULL))
    LEFT JOIN vocab USING (token) GROUP BY idx"""
sql.CTES["cut"] = "SELECT idx, len(ids) AS n, ids[1:512] AS c FROM rebuilt"
_HEAD = " + ".join(f"({w}::DOUBLE) * ({x})" for w, x in zip(inputs.CHAT_WEIGHTS, (
    "ln(1 + len(c))", "len(list_distinct(c))::DOUBLE / len(c)", f"len([x FOR x IN c IF x < {FIRST_ID}])::DOUBLE / len(c)")))


@query(
    "rollout_rewards",
    build(
        f"""SELECT idx, idx // {inputs.ROLLOUT_BATCH} AS batch_id, idx % {inputs.ROLLOUT_BATCH} AS pos,
            CASE WHEN n IS NOT NULL THEN least(n, 512) END AS n_tokens, n > 512 AS truncated, round(coalesce({_HEAD}, 0.0::DOUBLE), 6) AS reward, n IS NULL AS defaulted
        FROM posts LEFT JOIN cut USING (idx)""",
        *PAIRS,
        "chat_tokens",
        "vocab",
        "asked",
        "answered",
        "query_text",
        "response_text",
        "posts",
        "rebuilt",
        "cut",
    ),
)
def q_rollout_rewards(spark, sf_dir):
    out = scoring.rollout_rewards(inputs.logged_rollouts(spark, sf_dir), inputs.chat_vocab(spark, sf_dir), inputs.CHAT_WEIGHTS)
    return rounded(out, "reward")


@query(
    "batch_reward_stats",
    build(
        """SELECT batch_id, count(*) AS n_rows, round(avg(reward), 6) AS reward_mean, round(stddev_samp(reward), 6) AS reward_std,
            round(min(reward), 6) AS reward_min, round(max(reward), 6) AS reward_max FROM rewards GROUP BY batch_id""",
        *ROLLOUTS,
    ),
)
def q_stats(spark, sf_dir):
    return rounded(metrics.batch_reward_stats(_rewards(spark, sf_dir)), "reward_mean", "reward_std", "reward_min", "reward_max")


@query(
    "accum_loss",
    build(
        f"""SELECT run, epoch, batch_id // {GA} AS accum_group, round(sum(loss / {GA}), 6) AS accumulated_loss
        FROM run_steps GROUP BY ALL HAVING count(*) = {GA}""",
        "run_steps",
    ),
)
def q_accum(spark, sf_dir):
    out = metrics.accum_loss(inputs.run_steps(spark, sf_dir), accumulation=GA, by=["run", "epoch"])
    return rounded(out, "accumulated_loss")


@query(
    "eval_loss",
    build(
        """SELECT run, count(*) AS n_batches, round(avg(l), 6) AS eval_loss
        FROM (SELECT run, m // 16 AS b, avg(loss) AS l FROM run_steps GROUP BY ALL) GROUP BY run""",
        "run_steps",
    ),
)
def q_eval(spark, sf_dir):
    steps = inputs.run_steps(spark, sf_dir).withColumn("b", idiv("m", 16))
    return rounded(metrics.eval_loss(steps, by=["run"], batch=["b"]), "eval_loss")


@query(
    "metric_merge",
    build(
        """, stats AS (SELECT run, epoch AS step, avg(loss) AS mean, max(loss) AS top, count(*)::DOUBLE AS n FROM run_steps GROUP BY ALL)
        SELECT run, step, name, round(value, 6) AS value FROM (
            SELECT run, step, 'loss' AS name, top AS value FROM stats
            UNION ALL SELECT run, step, 'mean', mean FROM stats UNION ALL SELECT run, step, 'n', n FROM stats)""",
        "run_steps",
    ),
)
def q_merge(spark, sf_dir):
    steps = inputs.run_steps(spark, sf_dir).withColumnRenamed("epoch", "step")
    left = steps.groupBy("run", "step").agg(F.avg("loss").alias("mean"), F.avg("loss").alias("loss"))
    right = steps.groupBy("run", "step").agg(F.max("loss").alias("loss"), F.count("loss").cast("double").alias("n"))
    keys = ["run", "step"]
    layers = [left.unpivot(keys, ["mean", "loss"], "name", "value"), right.unpivot(keys, ["loss", "n"], "name", "value")]
    return rounded(metrics.metric_merge(layers, key=keys), "value")


@query(
    "metric_format",
    build(
        """SELECT run, m, format('{:.4f}', loss) AS loss, format('{:,}', m * 1000) AS n_seen FROM run_steps""",
        "run_steps",
    ),
)
def q_format(spark, sf_dir):
    rows = inputs.run_steps(spark, sf_dir).select("run", "m", "loss", (F.col("m") * 1000).alias("n_seen"))
    return metrics.metric_format(rows, {"loss": metrics.LOSS_FORMAT, "n_seen": metrics.COUNT_FORMAT})


@query(
    "metrics_long",
    build(
        """, stats AS (SELECT batch_id, avg(reward) AS reward_mean, stddev_samp(reward) AS reward_std,
                min(reward) AS reward_min, max(reward) AS reward_max FROM rewards GROUP BY batch_id)
        SELECT 'ppo' AS stage, batch_id AS step, 'rollouts' AS run, 'ppo/' || name AS name, round(value, 6) AS value FROM (
            SELECT batch_id, 'reward_mean' AS name, reward_mean AS value FROM stats UNION ALL SELECT batch_id, 'reward_std', reward_std FROM stats
            UNION ALL SELECT batch_id, 'reward_min', reward_min FROM stats UNION ALL SELECT batch_id, 'reward_max', reward_max FROM stats)""",
        *ROLLOUTS,
    ),
)
def q_long(spark, sf_dir):
    stats = metrics.batch_reward_stats(_rewards(spark, sf_dir)).withColumn("run", F.lit("rollouts"))
    long = runlog.metrics_long(stats, stage="ppo", metrics=["reward_mean", "reward_std", "reward_min", "reward_max"], step="batch_id")
    path = new_path(spark, "run-log")
    runlog.append_log(long, path)
    return rounded(runlog.read_log(spark, path), "value")


@query(
    "best_so_far",
    build(
        """SELECT run, step, eval_loss, coalesce(eval_loss < min(eval_loss) OVER (PARTITION BY run ORDER BY step
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS is_best FROM eval_points""",
        "run_steps",
        "eval_points",
    ),
)
def q_best(spark, sf_dir):
    return best.best_so_far(inputs.eval_points(spark, sf_dir))


@query(
    "best_checkpoint",
    build(
        """SELECT run, arg_min(step, {'l': eval_loss, 's': step}) AS best_step, min(eval_loss) AS best_loss FROM eval_points GROUP BY run""",
        "run_steps",
        "eval_points",
    ),
)
def q_checkpoint(spark, sf_dir):
    return best.best_checkpoint(inputs.eval_points(spark, sf_dir))


@query("sample_preview", build("SELECT batch_id, left(response, 100) || '...' AS sample FROM rollouts WHERE batch_id % 10 = 0 AND pos = 0", *PAIRS, "rollouts"))
def q_preview(spark, sf_dir):
    return metrics.sample_preview(inputs.placed_pairs(spark, sf_dir))


@query(
    "candidate_sampling",
    build(
        f""", z AS (SELECT prompt_id, cand_id, exp(logit / {SAMPLING.temperature}) AS e,
                row_number() OVER (PARTITION BY prompt_id ORDER BY logit DESC, cand_id) AS rank FROM candidates),
        k AS (SELECT *, e / sum(e) OVER (PARTITION BY prompt_id) AS p FROM z WHERE rank <= {SAMPLING.top_k}),
        m AS (SELECT *, coalesce(sum(p) OVER (PARTITION BY prompt_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS mass FROM k),
        q AS (SELECT *, p / sum(p) OVER (PARTITION BY prompt_id) AS q FROM m WHERE mass < {SAMPLING.top_p} OR rank = 1),
        b AS (SELECT *, coalesce(sum(q) OVER (PARTITION BY prompt_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                ('0x' || substr(md5(prompt_id || '|{SAMPLING.seed}'), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM q)
        SELECT prompt_id, arg_max(cand_id, rank) AS cand_id, round(arg_max(q, rank), 6) AS q, max(rank) AS rank
        FROM b WHERE before <= u GROUP BY prompt_id""",
        "candidates",
    ),
)
def q_sampling(spark, sf_dir):
    return rounded(sampling.sample_candidates(inputs.candidates(spark, sf_dir), SAMPLING), "q")


@query(
    "best_of_n",
    build(
        """SELECT prompt_id, count(*) AS n_candidates, arg_max(cand_id, {'r': logit, 'c': -cand_id}) AS cand_id,
            arg_max(response, {'r': logit, 'c': -cand_id}) AS response, round(max(logit), 6) AS reward FROM candidates GROUP BY prompt_id""",
        "candidates",
    ),
)
def q_best_of_n(spark, sf_dir):
    rewarded = inputs.candidates(spark, sf_dir).withColumnRenamed("logit", "reward")
    return rounded(best.best_of_n(rewarded), "reward")


_T = sql.tokens("text")
sql.CTES["doc_features"] = f"""SELECT doc_id, lang, quality, [ln(1 + length(text)), len(t)::DOUBLE / c, len(list_distinct(t))::DOUBLE / greatest(len(t), 1),
        length(regexp_replace(text, '[^0-9]', '', 'g'))::DOUBLE / c, length(regexp_replace(text, '[^A-Z]', '', 'g'))::DOUBLE / c,
        length(regexp_replace(text, '[^\\n]', '', 'g'))::DOUBLE / c] AS f
    FROM (SELECT doc_id, lang, quality, text, {_T} AS t, greatest(length(text), 1)::DOUBLE AS c FROM documents JOIN labels USING (doc_id))"""
sql.CTES["dealt"] = """SELECT *, row_number() OVER (PARTITION BY lang, quality ORDER BY doc_id) - 1 AS r,
        count(*) FILTER (quality = 0) OVER (PARTITION BY lang) AS n_bad FROM doc_features"""
# a bad document and all good ones it is dealt to make one component
sql.CTES["split_pairs"] = """SELECT *, CASE WHEN component % 10 = 9 THEN 'valid1' ELSE 'train' END AS split FROM (
        SELECT g.lang, g.doc_id AS chosen_id, b.doc_id AS rejected_id, g.f AS c, b.f AS r,
            least(b.doc_id, min(g.doc_id) OVER (PARTITION BY b.doc_id)) AS component
        FROM dealt g JOIN dealt b ON g.quality = 1 AND b.quality = 0 AND b.lang = g.lang AND b.r = g.r % nullif(g.n_bad, 0))"""
FEATURED = ("doc_features", "dealt", "split_pairs")
HEAD_REG, HEAD_STEPS = 1e-3, 1500
_J = ", ".join(f"avg(d[{j}] / (1 + exp(m)))" for j in range(1, len(models.TEXT_FEATURES) + 1))
# gradient steps with momentum down the penalised ranking loss, to its one optimum
_DIFFS = "SELECT list_transform(range(1, 7), lambda j: c[j] - r[j]) AS d FROM split_pairs WHERE split = 'train'"
HEAD = f""", diffs AS ({_DIFFS}),
    rate AS (SELECT sqrt(avg(list_inner_product(d, d)) / 4 + {HEAD_REG}) AS hi, sqrt({HEAD_REG}) AS lo FROM diffs),
    descent AS (SELECT 0 AS k, list_transform(range(6), lambda j: 0.0::DOUBLE) AS w, list_transform(range(6), lambda j: 0.0::DOUBLE) AS p
        UNION ALL SELECT k + 1, list_transform(range(1, 7), lambda j: w[j] - 4 / (hi + lo) ** 2 * ({HEAD_REG} * w[j] - g[j]) + ((hi - lo) / (hi + lo)) ** 2 * (w[j] - p[j])), w
            FROM (SELECT k, w, p, any_value(hi) AS hi, any_value(lo) AS lo, [{_J}] AS g
                FROM (SELECT k, w, p, hi, lo, d, list_inner_product(w, d) AS m FROM descent, diffs, rate WHERE k < {HEAD_STEPS}) GROUP BY k, w, p)),
    head AS (SELECT w FROM descent WHERE k = {HEAD_STEPS}),
    judged AS (SELECT lang, split, list_inner_product(w, c) AS chosen_score, list_inner_product(w, r) AS rejected_score FROM split_pairs, head)
    SELECT lang, count(*) AS n_pairs, round(avg({sql.softplus('rejected_score - chosen_score')}), 6) AS loss,
        round(avg((chosen_score > rejected_score)::INT::DOUBLE), 6) AS accuracy, round(avg(chosen_score), 6) AS chosen_reward_mean,
        round(avg(rejected_score), 6) AS rejected_reward_mean FROM judged WHERE split = '{{split}}' GROUP BY lang"""


def _split_pairs(spark, sf_dir) -> DataFrame:
    """Featured document pairs; a component of documents that meet in pairs is held out whole or not at all."""

    def make() -> DataFrame:
        return store(component_split(inputs.featured_doc_pairs(spark, sf_dir), a="chosen_id", b="rejected_id"), "split-pairs")

    return inputs._once(spark, sf_dir, "split_pairs", make)


def _head(spark, sf_dir) -> list[float]:
    """The reward head at the optimum of the training pairs: fitted, then refined."""

    def make() -> list[float]:
        train = _split_pairs(spark, sf_dir).filter("split = 'train'")
        differences = store(models.feature_differences(train), "differences")
        return models.refine_head(differences, models.head_weights(models.reward_fit(train, reg=HEAD_REG)), reg=HEAD_REG)

    return inputs._once(spark, sf_dir, "reward_head", make)


@query(
    "reward_split",
    build(
        """SELECT split, count(*) AS n_pairs, count(DISTINCT component) AS n_components, count(DISTINCT chosen_id) + count(DISTINCT rejected_id) AS n_documents,
            0::BIGINT AS shared_documents FROM split_pairs GROUP BY split""",
        *FEATURED,
    ),
)
def q_reward_split(spark, sf_dir):
    """Pairs, components and documents of both sides, and how many documents a side shares with the other: none."""
    rows = _split_pairs(spark, sf_dir)
    seen = rows.select("split", F.explode(F.array("chosen_id", "rejected_id")).alias("doc_id")).distinct()
    sides = seen.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_sides"))
    documents = seen.join(sides, "doc_id").groupBy("split").agg(
        F.count(F.lit(1)).alias("n_documents"), F.sum(F.when(F.col("n_sides") > 1, 1).otherwise(0)).alias("shared_documents")
    )
    found = rows.groupBy("split", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("split").agg(F.sum("n").alias("n_pairs"), F.count(F.lit(1)).alias("n_components"))
    return found.join(documents, "split").select("split", "n_pairs", "n_components", "n_documents", "shared_documents")


@query("reward_fit", build(HEAD.format(split="train"), *FEATURED, recursive=True))
def q_fit(spark, sf_dir):
    """Training metrics of the fitted head."""
    return _head_metrics(_split_pairs(spark, sf_dir).filter("split = 'train'"), _head(spark, sf_dir))


@query("reward_eval", build(HEAD.format(split="valid1"), *FEATURED, recursive=True))
def q_eval_head(spark, sf_dir):
    """Its metrics on pairs none of whose documents it has seen."""
    return _head_metrics(_split_pairs(spark, sf_dir).filter("split = 'valid1'"), _head(spark, sf_dir))


def _head_metrics(pairs: DataFrame, weights: list[float]) -> DataFrame:
    scored = pairs.select(
        "lang",
        scoring.reward_score("chosen_feature", weights).alias("chosen_score"),
        scoring.reward_score("rejected_feature", weights).alias("rejected_score"),
    )
    return rounded(metrics.pair_metrics(scored, by=["lang"]), "loss", "accuracy", "chosen_reward_mean", "rejected_reward_mean")


sql.CTES["lm_n"] = "SELECT prev, tok, count(*) AS n FROM grams WHERE doc_id % 10 < 8 GROUP BY ALL"
sql.CTES["lm_c"] = "SELECT prev, sum(n) AS c FROM lm_n GROUP BY prev"
sql.CTES["good_n"] = """SELECT prev, tok, count(*) AS n FROM grams
    WHERE doc_id % 10 < 8 AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) GROUP BY ALL"""
sql.CTES["good_c"] = "SELECT prev, sum(n) AS c FROM good_n GROUP BY prev"
sql.CTES["nll"] = """SELECT doc_id, count(*) AS n_tokens,
        sum(-ln((coalesce(a.n, 0) + 1.0::DOUBLE) / (coalesce(ac.c, 0) + (SELECT count(DISTINCT tok) FROM lm_n)))) AS reference,
        sum(-ln((coalesce(b.n, 0) + 1.0::DOUBLE) / (coalesce(bc.c, 0) + (SELECT count(DISTINCT tok) FROM good_n)))) AS policy
    FROM grams LEFT JOIN lm_n a USING (prev, tok) LEFT JOIN lm_c ac USING (prev)
    LEFT JOIN good_n b USING (prev, tok) LEFT JOIN good_c bc USING (prev) GROUP BY doc_id"""
LM = ("grams", "lm_n", "lm_c", "good_n", "good_c", "nll")


@query("lm_fit", build("SELECT prev, tok, n FROM lm_n", "grams", "lm_n"))
def q_lm(spark, sf_dir):
    return models.lm_counts(inputs.fit_documents(spark, sf_dir), key="doc_id")


_PART = "CASE WHEN doc_id % 10 < 8 THEN 'fit' ELSE 'held_out' END"


def _lm_parts(spark, sf_dir) -> DataFrame:
    """Scored documents with their part (fit or held out) and batch of 16 ids."""
    part = F.when(inputs.is_fit_part(), "fit").otherwise("held_out")
    return inputs.lm_scores(spark, sf_dir).withColumn("part", part).withColumn("batch_id", idiv("doc_id", 16))


@query(
    "lm_eval_loss",
    build(
        f"""SELECT lang, part, count(*) AS n_batches, round(avg(l), 6) AS eval_loss FROM (
            SELECT lang, {_PART} AS part, doc_id // 16 AS b, sum(policy) / sum(n_tokens) AS l FROM nll JOIN documents USING (doc_id) GROUP BY ALL)
        GROUP BY ALL""",
        *LM,
    ),
)
def q_lm_eval(spark, sf_dir):
    langs = inputs.table(spark, sf_dir, "documents").select("doc_id", "lang")
    scored = _lm_parts(spark, sf_dir).join(langs, "doc_id")
    return rounded(metrics.eval_loss(scored, by=["lang", "part"], batch=["batch_id"], loss="policy", tokens="n_tokens"), "eval_loss")


@query(
    "kl_watch",
    build(
        f"""SELECT part, b AS batch_id, count(*) AS n_rows, round(avg(r), 6) AS kl, round(avg(ln(1 + length(text)) - 0.2 * r), 6) AS penalised_reward,
            avg(r) > 0.1 AS over_target
        FROM (SELECT {_PART} AS part, doc_id // 16 AS b, (reference - policy) / n_tokens AS r, text FROM nll JOIN documents USING (doc_id)) GROUP BY ALL""",
        *LM,
    ),
)
def q_kl(spark, sf_dir):
    rewards = inputs.table(spark, sf_dir, "documents").select("doc_id", F.log(F.lit(1.0) + F.length("text")).alias("reward"))
    per_token = _lm_parts(spark, sf_dir).join(rewards, "doc_id").select(
        "part",
        "batch_id",
        "reward",
        (F.col("policy") / F.col("n_tokens")).alias("policy"),
        (F.col("reference") / F.col("n_tokens")).alias("reference"),
    )
    return rounded(models.kl_watch(per_token, by=["part", "batch_id"], reward="reward"), "kl", "penalised_reward")


RUN_TOTALS = """run_totals AS (SELECT event_type AS run, count(*) AS total_steps, avg(value) AS reward_mean, stddev_samp(value) AS reward_std,
    min(value) AS reward_min, max(value) AS reward_max FROM events GROUP BY event_type)"""


def _run_totals(spark, sf_dir) -> DataFrame:
    return inputs.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("run")).agg(
        F.count(F.lit(1)).alias("total_steps"), F.avg("value").alias("reward_mean"), F.stddev_samp("value").alias("reward_std"),
        F.min("value").alias("reward_min"), F.max("value").alias("reward_max"),
    )


@query(
    "run_manifest",
    f"""WITH {RUN_TOTALS} SELECT run, 'ppo_final' AS model_type, total_steps, round(reward_mean, 6) AS final_reward_mean,
        round(reward_std, 6) AS final_reward_std, round(reward_min, 6) AS reward_min, round(reward_max, 6) AS reward_max, 'sft' AS base_sft_model,
        'reward' AS reward_model, 1::BIGINT AS total_epochs, 8::BIGINT AS batch_size, 2::BIGINT AS mini_batch_size, 4::BIGINT AS ppo_epochs,
        0.1::DOUBLE AS target_kl, 0.00001::DOUBLE AS learning_rate, 0.2::DOUBLE AS cliprange,
        '0-9999' AS sft_samples, '10000-19999' AS reward_samples, '25000-29999' AS policy_samples FROM run_totals""",
)
def q_manifest(spark, sf_dir):
    fields = {
        "model_type": "ppo_final",
        "total_steps": F.col("total_steps"),
        "final_reward_mean": F.col("reward_mean"),
        "final_reward_std": F.col("reward_std"),
        "reward_range": {"reward_min": F.col("reward_min"), "reward_max": F.col("reward_max")},
        "base_sft_model": "sft",
        "reward_model": "reward",
        "total_epochs": 1,
        "training_config": manifests.POLICY_SETTINGS,
        "data_splits": manifests.plan_ranges(DEFAULT_PLAN),
    }
    written = manifests.run_manifest(_run_totals(spark, sf_dir), keep=["run"], fields={"run": F.col("run"), **fields})
    path = new_path(spark, "manifests")
    manifests.write_manifests(written, path)
    schema = """run STRING, model_type STRING, total_steps BIGINT, final_reward_mean DOUBLE, final_reward_std DOUBLE,
        reward_range STRUCT<reward_min: DOUBLE, reward_max: DOUBLE>, base_sft_model STRING, reward_model STRING, total_epochs BIGINT,
        training_config STRUCT<batch_size: BIGINT, mini_batch_size: BIGINT, ppo_epochs: BIGINT, target_kl: DOUBLE, learning_rate: DOUBLE, cliprange: DOUBLE>,
        data_splits STRUCT<sft_samples: STRING, reward_samples: STRING, policy_samples: STRING>"""
    back = manifests.read_manifests(spark, path, schema).select(
        "run", "model_type", "total_steps", "final_reward_mean", "final_reward_std",
        "reward_range.*", "base_sft_model", "reward_model", "total_epochs", "training_config.*", "data_splits.*",
    )
    return rounded(back, "final_reward_mean", "final_reward_std", "reward_min", "reward_max")


DUE_EVERY = 50


@query(
    "checkpoint_manifests",
    build(
        f""", sofar AS (SELECT run, step, eval_loss AS v, count(*) OVER w AS n, avg(eval_loss) OVER w AS mean, stddev_samp(eval_loss) OVER w AS std,
                avg(eval_loss) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN {DUE_EVERY - 1} PRECEDING AND CURRENT ROW) AS e
            FROM eval_points WINDOW w AS (PARTITION BY run ORDER BY step)),
        due AS (SELECT *, min(e) OVER (PARTITION BY run ORDER BY step) AS best, min(e) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior
            FROM sofar WHERE step % {DUE_EVERY} = 0)
        SELECT run, step AS epoch, n AS total_steps, round(mean, 6) AS reward_mean, round(std, 6) AS reward_std, round(v, 6) AS last_value, round(e, 6) AS eval_loss,
            round(best, 6) AS best_loss, prior IS NULL OR e < prior AS is_best, 'ppo_checkpoint' AS model_type, 'sft' AS base_sft_model, 'reward' AS reward_model FROM due""",
        "run_steps",
        "eval_points",
    ),
)
def q_checkpoints(spark, sf_dir):
    """A manifest after every 50th step of each run: what the run looks like so far and whether it is the best yet; written to a folder per run and read back."""
    states = manifests.checkpoint_states(inputs.eval_points(spark, sf_dir), value="eval_loss", every=DUE_EVERY)
    path = new_path(spark, "checkpoints")
    manifests.write_checkpoints(states, path, settings={"base_sft_model": "sft", "reward_model": "reward"})
    back = manifests.read_manifests(spark, path, manifests.CHECKPOINT_SCHEMA).drop("__run")
    return rounded(back, "reward_mean", "reward_std", "last_value", "eval_loss", "best_loss")


@query(
    "manifest_lookup",
    """SELECT user_id, CASE WHEN user_id % 5 < 2 THEN k ELSE -1 END AS k, CASE WHEN k IS NULL THEN 'absent' ELSE ['found', 'found', 'no key', 'malformed', 'wrong type'][user_id % 5 + 1] END AS reason
    FROM (SELECT user_id, max(event_id) FILTER (event_type = 'purchase' AND value > 40) AS k FROM events GROUP BY user_id)
    WHERE k IS NOT NULL UNION ALL
    SELECT user_id, -1, 'absent' FROM events GROUP BY user_id HAVING count(*) FILTER (event_type = 'purchase' AND value > 40) = 0""",
)
def q_lookup(spark, sf_dir):
    """A file per run, some without the key, broken off or of the wrong type, and runs without a file: one field for all of them, with its default."""
    events = inputs.table(spark, sf_dir, "events")
    last = events.filter("event_type = 'purchase' AND value > 40").groupBy("user_id").agg(F.max("event_id").alias("k"))
    k, case = F.col("k").cast("string"), F.col("user_id") % 5
    text = (
        F.when(case == 2, F.lit('{"other": 1}'))
        .when(case == 3, F.concat(F.lit('{"k": '), k))
        .when(case == 4, F.lit('{"k": [1]}'))
        .otherwise(F.concat(F.lit('{\n "k": '), k, F.lit("\n}")))
    )
    path = new_path(spark, "run-folders")
    manifests.write_folders(last.select("user_id", text.alias("value")), path, key="user_id", text="value", folder="user_id={}")
    runs = events.select("user_id").distinct()
    return manifests.folder_lookup(runs, path, key="user_id", name="k", ddl="BIGINT", default=-1, folder="user_id={}")


@query(
    "run_report",
    f"""WITH {RUN_TOTALS} SELECT run, '# Run ' || run || E'\\n\\n## Model\\n- Base model: sft\\n- Reward model: reward\\n- Final model: policy\\n\\n## Training\\n- Steps: '
        || total_steps || E'\\n- Final reward mean: ' || round(reward_mean, 3)::DECIMAL(18, 3)
        || E'\\n- Final reward deviation: ' || round(reward_std, 3)::DECIMAL(18, 3)
        || E'\\n\\n## Stages\\n- sft: rows 0-9999\\n- reward: rows 10000-19999\\n- policy: rows 25000-29999\\n' AS report FROM run_totals""",
)
def q_run_report(spark, sf_dir):
    totals = _run_totals(spark, sf_dir).withColumns({"base_model": F.lit("sft"), "reward_model": F.lit("reward"), "model": F.lit("policy")})
    return manifests.run_report(totals, plan=DEFAULT_PLAN)


@query(
    "stage_todo",
    """SELECT user_id AS run, stage FROM (SELECT DISTINCT user_id FROM events) u
        CROSS JOIN (VALUES ('sft', 'signup'), ('reward', 'purchase'), ('policy', 'view')) s(stage, mark)
        WHERE stage = 'policy' OR NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = u.user_id AND e.event_type = s.mark AND e.value > 60)""",
)
def q_todo(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events")
    stage_of = F.when(F.col("event_type") == "signup", "sft").when(F.col("event_type") == "purchase", "reward").when(F.col("event_type") == "view", "policy")
    done = events.filter("value > 60").select(F.col("user_id").alias("run"), stage_of.alias("stage")).filter("stage IS NOT NULL")
    stages = F.array(F.lit("sft"), F.lit("reward"), F.lit("policy"))
    planned = events.select(F.col("user_id").alias("run")).distinct().select("run", F.explode(stages).alias("stage"))
    planned = planned.withColumn("always", F.col("stage") == "policy")
    return ledger.stage_todo(planned, done).select("run", "stage")


@query(
    "stream_metrics",
    """SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n_rows, round(avg(value), 6) AS reward_mean,
        round(stddev_samp(value), 6) AS reward_std, min(value) AS reward_min, max(value) AS reward_max FROM events GROUP BY ALL""",
)
def q_stream(spark, sf_dir):
    source = live.read_events(spark, sf_dir)
    out = live.run_stream_metrics(source, window="1 day", late=live.LATE, mode="update")
    return rounded(out, "reward_mean", "reward_std")


def _arriving(spark, sf_dir) -> str:
    """A folder of events in files by week, written in order; a tenth of all is held back to the last file."""
    events = inputs.table(spark, sf_dir, "events")
    path = new_path(spark, "arriving")
    back = F.col("event_id") % 10 == 3
    week = F.date_trunc("day", "ts")
    cuts = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-02-01"]
    for a, b in zip(cuts, cuts[1:]):
        part = events.filter(~back & (week >= F.lit(a).cast("timestamp")) & (week < F.lit(b).cast("timestamp")))
        part.coalesce(1).write.mode("append").parquet(path)
    events.filter(back).coalesce(1).write.mode("append").parquet(path)
    return path


_WEEK = "CASE WHEN event_id % 10 = 3 THEN 4 WHEN ts < '2024-01-08' THEN 0 WHEN ts < '2024-01-15' THEN 1 WHEN ts < '2024-01-22' THEN 2 ELSE 3 END"


@query(
    "stream_late",
    f"""WITH e AS (SELECT *, {_WEEK} AS trigger FROM events),
    m AS (SELECT trigger, max(max(ts)) OVER (ORDER BY trigger ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL 7 DAY AS mark FROM e GROUP BY trigger)
    SELECT row_number() OVER (ORDER BY trigger) - 1 AS trigger, count(*) AS input_rows,
        count(*) - count(*) FILTER (coalesce(date_trunc('day', ts) + INTERVAL 1 DAY <= date_trunc('millisecond', mark), false)) AS accepted_rows,
        count(*) FILTER (date_trunc('day', ts) + INTERVAL 1 DAY <= date_trunc('millisecond', mark)) AS late_rows
    FROM e JOIN m USING (trigger) GROUP BY trigger""",
)
def q_stream_late(spark, sf_dir):
    """Events that come a week at a time, a tenth of them after all others: how many each trigger took and how many were behind the watermark.

    The watermark that a trigger's rows are held against is the one the trigger before it ran with: it comes from the rows up to two triggers back."""
    base = new_path(spark, "live-late")
    source = live.read_events(spark, _arriving(spark, sf_dir), pattern="*.parquet")
    live.run_stream_metrics(source, window="1 day", late="7 days", mode="append", base=base)
    return live.late_rows(spark, base).filter("input_rows > 0").select("trigger", "input_rows", "accepted_rows", "late_rows")


@query(
    "stream_best",
    """SELECT event_type AS run, event_id AS step, value AS loss FROM (SELECT *, min(value) OVER (PARTITION BY event_type ORDER BY event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM events) WHERE prior IS NULL OR value < prior""",
)
def q_stream_best(spark, sf_dir):
    source = live.read_events(spark, sf_dir)
    steps = source.select(F.col("event_type").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("loss"))
    return live_best.run_stream_best(steps)
