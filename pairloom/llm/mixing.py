"""Temperature mixing of sources, realised as budgeted block permutations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import fits_broadcast
from ..session import release, store

#: The exponent is a multiple of 1 / GRID.
GRID = 1 << 20
BLOCK_ROWS = 1024
SEED = 7
_SECTIONS = 32
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str | Column) -> Column:
    """Number of words of a text; null counts as empty."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("bigint")


def _digest(*parts) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))


def exponent(sources: DataFrame, budget: float, *, max_repeats: float | None = None, entropy: float | None = None) -> float:
    """The smallest exponent in [0, 1], on a grid, that meets the target.

    Weights are share^a / sum(share^a). With ``max_repeats`` no source may be read more than so
    often: the smallest source is the one repeated most, and less as a grows. With ``entropy``
    (nats) the weights' entropy must not exceed it; it falls as a grows. If even a = 1 does not
    meet the target, a is 1. Each pass cuts the interval into equal sections and needs
    only sums over the sources, so their number is not limited by the driver.
    """
    if (max_repeats is None) == (entropy is None):
        raise ValueError("give either max_repeats or entropy")
    total, least = sources.filter("tokens > 0").agg(F.sum("tokens"), F.min("tokens")).first()
    if not total:
        return 1.0
    share = F.col("tokens") / F.lit(float(total))
    low, high = -1, GRID  # low: does not meet the target, high: does (or is the end)
    while high - low > 1:
        marks = sorted({low + (high - low) * i // _SECTIONS for i in range(1, _SECTIONS)} - {low, high})
        sums = [x for m in marks for x in (F.sum(F.pow(share, m / GRID)), F.sum(F.pow(share, m / GRID) * F.log(share)))]
        got = sources.filter("tokens > 0").agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        for k, m in enumerate(marks):
            a, z, t = m / GRID, got[2 * k], got[2 * k + 1]
            met = budget / total * (least / total) ** (a - 1) / z <= max_repeats if entropy is None else math.log(z) - a * t / z <= entropy
            if met:
                high = m
                break
            low = m
    return high / GRID


def mix_sources(
    docs: DataFrame,
    *,
    budget: float | None = None,
    max_repeats: float | None = 2.0,
    entropy: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = SEED,
    block_rows: int = BLOCK_ROWS,
    place_col: str | None = None,
) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture takes it, with pass_no, block_no, n_tokens and order_key.

    A source's share of the tokens (words), raised to the found exponent and normalised, times
    ``budget`` (tokens; default: all there are) is what the source may give. Documents fall by a hash of their id into blocks
    of about ``block_rows``; every pass over a source permutes its blocks, and the documents in each block, anew.
    Whole passes are taken while they fit; the last pass takes, in its order, the documents
    up to the first that no longer fits. Sorting by (pass_no, order_key) reads a source in its mixed order.

    ``place_col`` names one more column, 0 to 1: the share of what the source gives that comes before the copy
    (by the blocks before it and, in its block, by its hash; a document counts its tokens and one). Sorting by it, then pass_no and
    order_key, keeps every source's mixed order and reads the sources side by side at their weights.

    Running sums are taken over blocks, and over documents only in the one block of a source in which its
    budget ends, so a source that holds most rows is never in one task.
    A null source is a source of its own; a null or empty text has no tokens and rides along
    with the pass; a null doc_id is an id of its own; rows that repeat an id stay or go together. The added
    columns replace columns of the same names.
    """
    ident = F.col(id_col)
    key = F.coalesce(F.col(source_col).cast("string"), F.lit("\0null"))
    narrow = store(docs.select(key.alias("s"), ident.cast("string").alias("id"), n_words(text_col).alias("tokens")), "mix-rows")
    sources = store(narrow.groupBy("s").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n")), "mix-sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    budget = float(total if budget is None else budget)
    a = exponent(sources, budget, max_repeats=max_repeats, entropy=entropy)
    share = F.pow(F.col("tokens") / F.lit(float(max(total, 1))), a)
    norm = sources.filter("tokens > 0").agg(F.sum(share)).first()[0] or 1.0
    allowed = F.floor(share / F.lit(norm) * F.lit(budget) + 0.5)
    plan = sources.select(
        "s",
        "tokens",
        F.ceil(F.col("n") / block_rows).alias("blocks"),
        F.when(F.col("tokens") > 0, F.floor(allowed / F.col("tokens"))).otherwise(1).cast("bigint").alias("whole"),
        F.when(F.col("tokens") > 0, allowed % F.col("tokens")).otherwise(0).cast("bigint").alias("rest"),
    )
    plan = store(plan, "mix-plan")

    def placed(rows: DataFrame) -> DataFrame:
        side = (F.broadcast(plan) if fits_broadcast(plan) else plan).drop("tokens")
        bucket = F.conv(F.substring(_digest(F.lit(seed), F.col("id")), 1, 8), 16, 10).cast("bigint")
        return rows.join(side, "s").withColumn("block_no", bucket % F.col("blocks"))

    def block_key(pass_no: Column) -> Column:
        return _digest(F.lit(seed), pass_no, F.col("s"), F.col("block_no"))

    def doc_key(pass_no: Column) -> Column:
        return _digest(F.lit(seed), pass_no, F.col("id"))

    rows = placed(narrow)
    sizes = rows.groupBy("s", "block_no", "whole", "rest").agg(F.sum("tokens").alias("size"))
    order = Window.partitionBy("s").orderBy("key", "block_no").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("key", block_key(F.col("whole"))).withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))
    state = F.when(F.col("before") + F.col("size") <= F.col("rest"), "all").when(F.col("before") < F.col("rest"), "part").otherwise("none")
    blocks = store(before.withColumn("state", state).select("s", "block_no", "before", "state"), "mix-blocks")

    ends = F.broadcast(blocks.filter("state = 'part'")) if fits_broadcast(blocks) else blocks.filter("state = 'part'")
    inside = rows.join(ends, ["s", "block_no"]).withColumn("dkey", doc_key(F.col("whole")))
    within = Window.partitionBy("s").orderBy("dkey")
    cut = inside.withColumn("upto", F.col("before") + F.sum("tokens").over(within)).filter("upto <= rest")
    taken = cut.groupBy("s", "block_no").agg(F.max("dkey").alias("cut"), (F.sum("tokens") + F.count(F.lit(1))).alias("taken"))
    cuts = blocks.join(taken, ["s", "block_no"], "left")
    cuts = cuts.select("s", "block_no", "state", F.coalesce("cut", F.lit("")).alias("cut"), F.coalesce("taken", F.lit(0)).alias("taken"))
    if place_col:
        cuts = cuts.join(_starts(rows, block_key, cuts), ["s", "block_no"])
    cuts = store(cuts, "mix-cuts")
    release(narrow, sources, blocks)

    whole = docs.drop("pass_no", "block_no", "n_tokens", "order_key", *([place_col] if place_col else []))
    work = whole.select(F.struct("*").alias("doc"), key.alias("s"), ident.cast("string").alias("id"), n_words(text_col).alias("n_tokens"))
    side = F.broadcast(cuts) if fits_broadcast(cuts) else cuts
    work = placed(work).join(side, ["s", "block_no"])
    partial = (F.col("state") == "all") | ((F.col("state") == "part") & (doc_key(F.col("whole")) <= F.col("cut")))
    passes = F.col("whole") + partial.cast("bigint")
    copies = work.filter(passes > 0).withColumn("pass_no", F.explode(F.sequence(F.lit(0).cast("bigint"), passes - 1)))
    out = ["doc.*", "pass_no", "block_no", "n_tokens", F.concat(block_key(F.col("pass_no")), doc_key(F.col("pass_no"))).alias("order_key")]
    if place_col:
        inner, reach = _share(doc_key(F.col("pass_no"))), _share(F.col("cut"))
        last = (F.col("pass_no") == F.col("whole")) & (F.col("state") == "part")
        # of the block in which a source ends, only the documents up to the cut are there
        offset = F.when(last, F.when(reach > 0, inner / reach * F.col("taken")).otherwise(0.0)).otherwise(inner * F.col("width"))
        at = F.element_at("starts", (F.col("pass_no") + 1).cast("int")) + offset
        out.append((at / F.col("given")).alias(place_col))
    return copies.select(*out)


def _share(digest: Column) -> Column:
    """Where a digest lies among all, 0 to 1."""
    return F.coalesce(F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32)), F.lit(0.0))


def _starts(rows: DataFrame, block_key, cuts: DataFrame) -> DataFrame:
    """Per (s, block_no): its width, by pass the width of all that its source gives before it, and the width of all that the source gives."""
    sizes = rows.groupBy("s", "block_no", "whole").agg((F.sum("tokens") + F.count(F.lit(1))).alias("width"))
    passes = sizes.withColumn("pass_no", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("whole"))))
    order = Window.partitionBy("s", "pass_no").orderBy("key", "block_no").rowsBetween(Window.unboundedPreceding, -1)
    before = passes.withColumn("key", block_key(F.col("pass_no"))).withColumn("before", F.coalesce(F.sum("width").over(order), F.lit(0)))
    last = F.when(F.col("state") == "all", F.col("width")).when(F.col("state") == "part", F.col("taken")).otherwise(0)
    total = sizes.join(cuts, ["s", "block_no"]).groupBy("s").agg(F.sum("width").alias("total"), (F.max("whole") * F.sum("width") + F.sum(last)).alias("given"))
    listed = before.join(total, "s").groupBy("s", "block_no", "width", "given").agg(
        F.array_sort(F.collect_list(F.struct("pass_no", (F.col("pass_no") * F.col("total") + F.col("before")).cast("double").alias("at")))).alias("list")
    )
    return listed.select("s", "block_no", "width", "given", F.col("list.at").alias("starts"))


#: The same mixture in DuckDB, for ``mix_sources`` with its default parameters.
SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(source, chr(0) || 'null') s, coalesce(doc_id::VARCHAR, 'null') id,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) tokens FROM documents),
src AS MATERIALIZED (SELECT s, sum(tokens)::BIGINT tokens, count(*) n FROM d GROUP BY s),
tot AS (SELECT sum(tokens)::DOUBLE t, min(tokens) FILTER (tokens > 0)::DOUBLE least FROM src),
bis(low, high) AS (
    SELECT -1::BIGINT, {GRID}::BIGINT
    UNION ALL
    SELECT CASE WHEN met THEN low ELSE mid END, CASE WHEN met THEN mid ELSE high END FROM (
        SELECT low, high, mid, pow(least / t, mid / {GRID}::DOUBLE - 1) / z <= 2.0 met FROM (
            SELECT low, high, (low + high) // 2 mid, (SELECT sum(pow(tokens / t, ((low + high) // 2) / {GRID}::DOUBLE)) FROM src, tot WHERE tokens > 0) z
            FROM bis WHERE high - low > 1), tot)),
e AS (SELECT min(high) / {GRID}::DOUBLE a FROM bis),
norm AS (SELECT sum(pow(tokens / t, a)) z FROM src, tot, e WHERE tokens > 0),
plan AS (SELECT s, tokens, ceil(n / {BLOCK_ROWS}.0)::BIGINT blocks, floor(pow(tokens / t, a) / z * t + 0.5)::BIGINT allowed FROM src, tot, e, norm),
plan2 AS (SELECT s, blocks, CASE WHEN tokens > 0 THEN allowed // tokens ELSE 1 END whole, CASE WHEN tokens > 0 THEN allowed % tokens ELSE 0 END rest FROM plan),
r AS (SELECT d.*, whole, rest, ('0x' || left(md5('{SEED}|' || id), 8))::BIGINT % blocks block_no FROM d JOIN plan2 USING (s)),
b AS (SELECT s, block_no, whole, rest, sum(tokens) size FROM r GROUP BY ALL),
c AS (SELECT s, block_no, size, coalesce(sum(size) OVER (PARTITION BY s ORDER BY md5('{SEED}|' || whole || '|' || s || '|' || block_no), block_no
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) bef FROM b),
q AS (SELECT r.*, bef, size, sum(tokens) OVER (PARTITION BY s, block_no ORDER BY md5('{SEED}|' || whole || '|' || id)) + bef upto FROM r JOIN c USING (s, block_no))
SELECT doc_id, source, pass_no, block_no::BIGINT block_no, tokens::BIGINT n_tokens,
    md5('{SEED}|' || pass_no || '|' || s || '|' || block_no) || md5('{SEED}|' || pass_no || '|' || id) order_key
FROM (SELECT *, unnest(range(0, whole + CASE WHEN bef + size <= rest OR (bef < rest AND upto <= rest) THEN 1 ELSE 0 END)) pass_no FROM q)
"""
