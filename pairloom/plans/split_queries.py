"""Queries on sources, row order, stage splits and rendering."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..functions.chat import DEFAULT_TEMPLATE, INSTRUCTION, chat_array, completion_tail, extract_post, user_prompt
from ..operators import chats, splits
from ..operators.coverage import coverage_report
from ..operators.rowindex import indexed, row_index
from ..operators.splits import StagePlan
from ..session import new_path, store
from ..sources.comparisons import complete_rows, load_comparisons, load_json
from . import inputs, sql
from .registry import query
from .sql import PAIRS, build

@query("load_comparisons", build("SELECT idx, split, prompt, chosen, rejected FROM pairs", *PAIRS))
def q_load(spark, sf_dir):
    rows = complete_rows(load_comparisons(spark, inputs.pairs(spark, sf_dir).path))
    return rows.select("idx", "split", "prompt", "chosen", "rejected")


@query("split_select", build("SELECT idx, split_pos, prompt FROM pairs WHERE split = 'valid1'", *PAIRS))
def q_split(spark, sf_dir):
    rows = load_comparisons(spark, inputs.pairs(spark, sf_dir).path, split="valid1")
    return rows.select("idx", "split_pos", "prompt")


@query(
    "row_index",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS idx, "
    "row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) - 1 AS group_idx FROM orders",
)
def q_row_index(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    whole = row_index(orders, ["o_orderdate", "o_orderkey"])
    grouped = row_index(whole, ["idx"], partition_by=["o_orderpriority"], name="group_idx")
    return grouped.select("o_orderkey", "idx", "group_idx")


@query("head_n", build("SELECT split_pos AS idx, conv_id, turn FROM train WHERE split_pos < n * 4 // 10", *PAIRS, "train"))
def q_head(spark, sf_dir):
    first = inputs.stage_plan(spark, sf_dir).stages[0]
    return splits.head_n(inputs.train_rows(spark, sf_dir), first.end).select("idx", "conv_id", "turn")


@query("slice_rows", build("SELECT split_pos AS idx, conv_id, turn FROM train WHERE split_pos >= n * 4 // 10 AND split_pos < n * 2", *PAIRS, "train"))
def q_slice(spark, sf_dir):
    n = inputs.pairs(spark, sf_dir).train_count
    return splits.slice_rows(inputs.train_rows(spark, sf_dir), n * 4 // 10, n * 2).select("idx", "conv_id", "turn")


@query("stage_assign", build(f"SELECT split_pos AS idx, {sql.stage_case('split_pos', 'n')} AS stage FROM train", *PAIRS, "train"))
def q_assign(spark, sf_dir):
    rows = inputs.train_rows(spark, sf_dir).select("idx")
    return splits.stage_assign(rows, inputs.stage_plan(spark, sf_dir))


@query(
    "split_report",
    build(
        f"""SELECT stage, count(i) AS n_rows, min(i) AS first_idx, max(i) AS last_idx,
            min(i) || '-' || max(i) AS range, CASE WHEN stage LIKE 'gap_%' THEN 1 ELSE 0 END::BIGINT AS is_gap
        FROM (VALUES ('sft'), ('reward'), ('policy'), ('gap_before_policy')) s(stage)
        FULL JOIN (SELECT split_pos AS i, {sql.stage_case('split_pos', 'n', gaps=True)} AS stage FROM train) USING (stage) GROUP BY stage""",
        *PAIRS,
        "train",
    ),
)
def q_report(spark, sf_dir):
    return splits.split_report(inputs.train_rows(spark, sf_dir), inputs.stage_plan(spark, sf_dir))


@query(
    "leakage_audit",
    build(
        """SELECT 'text' AS field, s.idx, s.stage, s.h AS text_hash
        FROM staged s JOIN (SELECT h FROM staged GROUP BY h HAVING count(DISTINCT stage) > 1) l USING (h)""",
        "doc_rank",
        "staged",
    ),
)
def q_leakage(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents", spread=True).select("doc_id", "text")
    numbered, n = indexed(splits.hash_texts(docs, ("text",)), ["doc_id"])
    staged = numbered.withColumn("stage", StagePlan.scaled(n).label("idx", with_gaps=True))
    return splits.leakage_audit(staged, ("text",)).select("field", "idx", "stage", "text_hash")


#: Every ninth row takes the prompt of the row half a table away, which lies in another stage or a gap.
_PLANTED = f"""SELECT a.split_pos AS idx, {sql.stage_case('a.split_pos', 'a.n', gaps=True)} AS stage,
        CASE WHEN a.split_pos % 9 = 4 THEN b.prompt ELSE a.prompt END AS prompt, a.chosen
    FROM train a JOIN train b ON b.split_pos = (a.split_pos + a.n // 2) % a.n"""


@query(
    "leakage_pairs",
    build(
        rf""", planted AS ({_PLANTED}),
        hashed AS (SELECT field, idx, stage, md5(trim(lower(regexp_replace(t, '[ \t\n\r]+', ' ', 'g')), ' ')) AS h
            FROM (SELECT idx, stage, 'prompt' AS field, prompt AS t FROM planted UNION ALL SELECT idx, stage, 'chosen', chosen FROM planted)),
        leaks AS (SELECT field, h FROM hashed GROUP BY field, h HAVING count(DISTINCT stage) > 1)
        SELECT field, idx, stage, h AS text_hash FROM hashed JOIN leaks USING (field, h)
        UNION ALL SELECT 'idx', split_pos, s, NULL FROM train, (VALUES ('policy'), ('extra')) v(s)
            WHERE split_pos >= n * 85 // 100 AND split_pos < n * 9 // 10""",
        *PAIRS,
        "train",
    ),
)
def q_leakage_pairs(spark, sf_dir):
    """Rows that more than one stage sees: by equal prompt or answer, after copies were planted across stages, and by index, for a run that takes rows from 85% on."""
    n, plan = inputs.pairs(spark, sf_dir).train_count, inputs.stage_plan(spark, sf_dir)
    rows = inputs.train_rows(spark, sf_dir).select("idx", "prompt", "chosen")
    taken = rows.filter(F.pmod("idx", F.lit(9)) == 4).select("idx", F.pmod(F.col("idx") + n // 2, F.lit(max(n, 1))).alias("source"))
    copies = taken.join(rows.select(F.col("idx").alias("source"), F.col("prompt").alias("copy")), "source").drop("source")
    planted = rows.join(copies, "idx", "left").select("idx", F.coalesce("copy", "prompt").alias("prompt"), "chosen")
    staged = planted.withColumn("stage", plan.label("idx", with_gaps=True))
    by_text = splits.leakage_audit(splits.hash_texts(staged)).select("field", "idx", "stage", "text_hash")
    policy = next(s for s in plan.stages if s.name == "policy")
    runs = splits.slice_rows(rows.select("idx"), policy.start, policy.end).withColumn("stage", F.lit("policy"))
    runs = runs.unionByName(splits.slice_rows(rows.select("idx"), n * 85 // 100, n).withColumn("stage", F.lit("extra")))
    by_index = runs.join(splits.overlapping_rows(runs).select("idx"), "idx")
    return by_text.unionByName(by_index.select(F.lit("idx").alias("field"), "idx", "stage", F.lit(None).cast("string").alias("text_hash")))


_KEPT = "length(chosen) % 5 <> 0"


@query(
    "split_coverage",
    build(
        f""", written AS (SELECT split_pos AS i, {sql.stage_case('split_pos', 'n')} AS stage FROM train WHERE {_KEPT}),
        used AS (SELECT * FROM written WHERE stage <> 'unused'),
        runs AS (SELECT stage, i, i - row_number() OVER (PARTITION BY stage ORDER BY i) AS g FROM used),
        free AS (SELECT split_pos AS i, split_pos - row_number() OVER (ORDER BY split_pos) AS g FROM train WHERE split_pos NOT IN (SELECT i FROM used))
        SELECT stage, min(i) AS first_idx, max(i) AS last_idx, count(*) AS n_rows FROM runs GROUP BY stage, g
        UNION ALL SELECT '(none)', min(i), max(i), 0 FROM free GROUP BY g""",
        *PAIRS,
        "train",
    ),
)
def q_coverage(spark, sf_dir):
    """Unbroken ranges of each stage and of no stage, from the rows the stages have written; rows whose answer has a length divisible by 5 were left out."""
    rows = inputs.train_rows(spark, sf_dir).filter(_KEPT).select("idx", "chosen")
    staged = splits.stage_assign(rows.select("idx"), inputs.stage_plan(spark, sf_dir)).filter("stage <> 'unused'")
    written = store(staged, "stage-rows", partition_by=("stage",))
    return coverage_report(written, inputs.pairs(spark, sf_dir).train_count)


_BROKEN = {0: "malformed", 1: "not text chosen", 2: "null rejected", 3: "missing prompt", 4: "not an object", 5: "not text prompt"}


@query(
    "load_json",
    build(
        "SELECT CASE idx % 20 {} ELSE 'kept' END AS reason, split, count(*) AS n_rows, sum(CASE WHEN idx % 20 > 5 THEN length(prompt) + length(chosen) + length(rejected) END)::BIGINT AS n_chars, "
        "sum(CASE WHEN idx % 20 > 5 THEN idx END)::BIGINT AS idx_sum FROM pairs GROUP BY ALL".format(" ".join(f"WHEN {k} THEN '{v}'" for k, v in _BROKEN.items())),
        *PAIRS,
    ),
)
def q_load_json(spark, sf_dir):
    """Comparisons written as JSON lines, some broken off, of the wrong type, null or without a field; read back, with what was kept and why the rest was not."""
    rows, case = inputs.pairs(spark, sf_dir).rows, F.col("idx") % 20

    def line(**fields) -> Column:
        return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]), {"ignoreNullFields": "false"})

    p, c, r, i = (F.col(x) for x in ("prompt", "chosen", "rejected", "idx"))
    whole = line(prompt=p, chosen=c, rejected=r, idx=i, split=F.col("split"))
    text = (
        F.when(case == 0, F.expr("left(whole, length(whole) - 3)"))
        .when(case == 1, line(prompt=p, chosen=F.length(c), rejected=r, idx=i))
        .when(case == 2, line(prompt=p, chosen=c, rejected=F.lit(None).cast("string"), idx=i))
        .when(case == 3, line(chosen=c, rejected=r, idx=i))
        .when(case == 4, F.to_json(F.array(p, c, r)))
        .when(case == 5, line(prompt=F.struct(p.alias("text")), chosen=c, rejected=r, idx=i))
        .otherwise(F.col("whole"))
    )
    path = new_path(spark, "comparisons-json")
    rows.withColumn("whole", whole).select("split", text.alias("line")).write.partitionBy("split").text(path)
    kept, refused = load_json(spark, path, extra="idx BIGINT, split STRING")
    none = F.lit(None).cast("bigint")
    counted = kept.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("prompt") + F.length("chosen") + F.length("rejected")).cast("bigint").alias("n_chars"), F.sum("idx").alias("idx_sum")
    )
    refused = refused.groupBy("reason", F.regexp_extract("file", "split=([^/]+)/", 1).alias("split")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(F.lit("kept").alias("reason"), "split", "n_rows", "n_chars", "idx_sum").unionByName(
        refused.select("reason", "split", "n_rows", none.alias("n_chars"), none.alias("idx_sum"))
    )


@query(
    "overlapping_rows",
    build(
        """SELECT split_pos AS idx, 2::INTEGER AS n_stages FROM train WHERE split_pos >= n * 3 // 10 AND split_pos < n * 4 // 10""",
        *PAIRS,
        "train",
    ),
)
def q_overlap(spark, sf_dir):
    """Audit by index range: two runs whose ranges overlap by a tenth of the rows."""
    rows, n = inputs.train_rows(spark, sf_dir).select("idx"), inputs.pairs(spark, sf_dir).train_count
    first = splits.slice_rows(rows, 0, n * 4 // 10).withColumn("stage", F.lit("first"))
    second = splits.slice_rows(rows, n * 3 // 10, n).withColumn("stage", F.lit("second"))
    return splits.overlapping_rows(first.union(second))


@query("user_prompt", build(f"SELECT idx, {sql.user('prompt')} AS text FROM pairs", *PAIRS))
def q_user(spark, sf_dir):
    return inputs.pairs(spark, sf_dir).rows.select("idx", user_prompt("prompt").alias("text"))


@query(
    "chat_array",
    build(
        f"""SELECT idx, 0::BIGINT AS place, 'system' AS role, {sql.text(sql.SYSTEM_PROMPT)} AS content FROM pairs
        UNION ALL SELECT idx, 1, 'user', {sql.user('prompt')} FROM pairs
        UNION ALL SELECT idx, 2, 'assistant', chosen FROM pairs""",
        *PAIRS,
    ),
)
def q_chat(spark, sf_dir):
    rows = inputs.pairs(spark, sf_dir).rows.select("idx", F.posexplode(chat_array("prompt", "chosen")).alias("place", "m"))
    return rows.select("idx", F.col("place").cast("bigint").alias("place"), "m.role", "m.content")


@query("render_chat", build(f"SELECT idx, {sql.chat('prompt', 'chosen')} AS text FROM pairs", *PAIRS))
def q_render(spark, sf_dir):
    return chats.render_sft(inputs.pairs(spark, sf_dir).rows)


@query("render_prompt", build(f"SELECT idx, {sql.prompt_chat('prompt')} AS query FROM pairs", *PAIRS))
def q_render_prompt(spark, sf_dir):
    return chats.render_prompts(inputs.pairs(spark, sf_dir).rows)


_FALSE_TURN = f"{DEFAULT_TEMPLATE.end}\n{DEFAULT_TEMPLATE.cue}"


@query("render_markers", build(f"SELECT idx, {sql.chat('(prompt || ' + sql.text(_FALSE_TURN) + ' || chosen)', 'rejected')} AS text FROM pairs", *PAIRS))
def q_render_markers(spark, sf_dir):
    """Posts that hold the template's markers open no turn of their own."""
    posts = inputs.pairs(spark, sf_dir).rows.select("idx", F.concat("prompt", F.lit(_FALSE_TURN), "chosen").alias("prompt"), F.col("rejected").alias("chosen"))
    return chats.render_sft(posts)


@query(
    "render_pairs",
    build(f"SELECT idx, {sql.chat('prompt', 'chosen')} AS chosen_text, {sql.chat('prompt', 'rejected')} AS rejected_text FROM pairs", *PAIRS),
)
def q_render_pairs(spark, sf_dir):
    return chats.render_pairs(inputs.pairs(spark, sf_dir).rows)


@query(
    "render_conversations",
    f"""SELECT conv_id, count(*) AS n_turns,
        string_agg('{sql.START}' || role || E'\\n' || text || E'{sql.END}\\n', '' ORDER BY turn) AS text
    FROM conversations GROUP BY conv_id""",
)
def q_conversations(spark, sf_dir):
    return chats.render_conversations(inputs.table(spark, sf_dir, "conversations"))


#: From the contract: a rendered post comes back as it was shown, its first line alone in the default mode; a text without
#: the instruction is the post itself; an instruction without a line break gives none.
@query(
    "extract_post",
    build(
        f"""SELECT idx, CASE idx % 3 WHEN 0 THEN split_part({sql.escaped('prompt')}, E'\\n', 1) WHEN 1 THEN prompt END AS post,
            CASE idx % 3 WHEN 0 THEN {sql.escaped('prompt')} WHEN 1 THEN prompt END AS whole_post FROM pairs""",
        *PAIRS,
    ),
)
def q_extract(spark, sf_dir):
    logged = (
        F.when(F.col("idx") % 3 == 0, DEFAULT_TEMPLATE.render(chat_array("prompt"), add_cue=True))
        .when(F.col("idx") % 3 == 1, F.col("prompt"))
        .otherwise(F.concat(F.lit(f"{INSTRUCTION} "), "prompt"))
    )
    rows = inputs.pairs(spark, sf_dir).rows.select("idx", logged.alias("query"))
    return rows.select("idx", extract_post("query").alias("post"), extract_post("query", mode="full").alias("whole_post"))


@query(
    "completion_tail",
    build(r"SELECT idx, trim(substr(prompt || E' \n' || chosen || E' \t\n', length(prompt) + 1), E' \n\t\r') AS tail FROM pairs", *PAIRS),
)
def q_tail(spark, sf_dir):
    full = F.concat("prompt", F.lit(" \n"), "chosen", F.lit(" \t\n"))
    return inputs.pairs(spark, sf_dir).rows.select("idx", completion_tail(full, "prompt").alias("tail"))
