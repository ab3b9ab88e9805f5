"""How filters interact: failing-id relations, and joins of them for every prefix of every order."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import attach
from ..session import store
from .common import BYTE_VALUE, row_runs, text_view
from .runs import byte_class, run_hashes

FILTERS = "ABCDE"
WORD = ~byte_class((0x20, 0x20), (0x09, 0x0D))
_UPPER = byte_class((0x41, 0x5A))
_SYMBOL = byte_class(*((ord(c), ord(c)) for c in "#$%&*|"))
_FOLLOWS = byte_class((0x80, 0xBF))  # bytes of a character after its first
_NAMES = ["words", "distinct_words", "chars", "uppers", "symbols"]
_MEASURED = "doc_id bigint, part string, digest binary, " + ", ".join(f"{c} bigint" for c in _NAMES)
#: Rows of a batch that are measured at once.
_ROWS = 1024


def _measures(texts: pa.Array) -> pa.Array:
    """Per text the numbers that the filters ask for; texts are worked on in pieces of bounded size."""
    data, offsets = text_view(texts)
    out = np.zeros((5, len(texts)), np.int64)
    for i, j in row_runs(offsets):
        hashes, rows = run_hashes(data, offsets, i, j, WORD, BYTE_VALUE)
        out[0, i:j] = np.bincount(rows, minlength=j - i)
        order = np.lexsort((hashes, rows))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(hashes[order]) != 0) | (np.diff(rows[order]) != 0)
        out[1, i:j] = np.bincount(rows[order[new]], minlength=j - i)
        bounds = offsets[i : j + 1] - offsets[i]
        piece = data[offsets[i] : offsets[j]]
        for k, member in ((2, ~_FOLLOWS), (3, _UPPER), (4, _SYMBOL)):
            upto = np.concatenate([[0], np.cumsum(member[piece], dtype=np.int32)])
            out[k, i:j] = np.diff(upto[bounds])
    return pa.StructArray.from_arrays([pa.array(c) for c in out], _NAMES)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the measures of their text in its place: no text comes back, and none waits in the JVM for its measures."""
    for whole in batches:
        for at in range(0, len(whole), _ROWS):
            batch = whole.slice(at, _ROWS)
            kept = [batch.column(c) for c in ("doc_id", "part", "digest")]
            yield pa.RecordBatch.from_arrays([*kept, *_measures(batch.column("text")).flatten()], names=["doc_id", "part", "digest", *_NAMES])


def _firsts(rows: DataFrame) -> DataFrame:
    """(digest, first, copies): the smallest doc_id of each text that occurs more than once."""
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    return groups.filter(F.col("copies") > 1)


def failing_ids(docs: DataFrame, labels: DataFrame | None, *, id_col: str, text_col: str, part_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows (row, part) of ``docs``, and the failing-id relations (filter, row, part, good, toxic), one stored partition per filter.

    ``row`` is a number that each row of the stored table has for itself; labels are looked up by doc_id.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    asked = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.md5(text)).alias("digest"),
        text.alias("text"),
    )
    measured = asked.mapInArrow(_measured, _MEASURED)
    words, distinct, chars, uppers, symbols = (F.col(c) for c in _NAMES)
    slim = measured.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "part", "digest",
        (words < 200).alias("A"), (100 * distinct < 50 * words).alias("B"), (100 * uppers > 3 * chars).alias("C"), (symbols > 0).alias("D"),
    )
    slim = store(slim, "audit-rows")
    firsts = store(_firsts(slim), "audit-copies")
    known = attach(slim, firsts, ["digest"], weight="copies", spread=["row"])
    flags = known.withColumn("E", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)))
    failed = flags.select("row", "doc_id", "part", F.array_compact(F.array(*[F.when(F.col(f), f) for f in FILTERS])).alias("fails")).filter(F.size("fails") > 0)
    if labels is None:
        marked = failed.withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    else:
        by_id = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
            F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
            F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"),
        )
        some = by_id.filter((F.col("good") > 0) | (F.col("toxic") > 0))
        marked = failed.join(some, "doc_id", "left").na.fill(0, ["good", "toxic"])
    relations = marked.select("row", "part", "good", "toxic", F.explode("fails").alias("filter"))
    return slim.select("row", "part"), store(relations, "audit-fails", partition_by=("filter",))


def _sets(holding: str | None = None, without: str | None = None) -> Column:
    """Sets of filters as bit numbers, as a literal array: those that hold one filter, or those without one."""
    bit = lambda f: 1 << FILTERS.index(f)
    chosen = [s for s in range(1 << len(FILTERS)) if (holding is None or s & bit(holding)) and (without is None or not s & bit(without))]
    return F.array(*[F.lit(s) for s in chosen])


def prefix_counts(fails: DataFrame) -> DataFrame:
    """(part, filter, before, removed, redundant, good_lost, toxic_lost) for each filter and each set of filters before it.

    What a prefix removes depends on the set of its filters alone, so the 325 prefixes of all orders are 80 pairs of a set and a
    next filter. An id that fails any filter of a set is lost to it: the set's relation. A filter's failing ids
    without the set's relation (left anti) are what it removes after that set, those within it (left semi) are redundant.
    All sets are joined at once, with the set as part of the key.
    """
    each = [(f, fails.filter(F.col("filter") == f).drop("filter")) for f in FILTERS]
    lost, asked = None, None
    for f, rows in each:
        gone = rows.select("row", F.explode(_sets(holding=f)).alias("before"))
        next_ = rows.select("row", "part", "good", "toxic", F.lit(f).alias("filter"), F.explode(_sets(without=f)).alias("before"))
        lost, asked = (gone, next_) if lost is None else (lost.unionByName(gone), asked.unionByName(next_))
    key, group = ["row", "before"], ["part", "filter", "before"]
    # a relation may hold an id several times: neither join multiplies rows
    removed = asked.join(lost, key, "left_anti").groupBy(*group).agg(
        F.count(F.lit(1)).alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost"), F.lit(0).cast("bigint").alias("redundant")
    )
    redundant = asked.join(lost, key, "left_semi").groupBy(*group).agg(F.count(F.lit(1)).alias("redundant"))
    zero = F.lit(0).cast("bigint")
    both = removed.unionByName(redundant.select(*group, zero.alias("removed"), zero.alias("good_lost"), zero.alias("toxic_lost"), "redundant"))
    return both.groupBy(*group).agg(*[F.sum(c).alias(c) for c in ("removed", "redundant", "good_lost", "toxic_lost")])


def _orders(spark) -> DataFrame:
    """(o, filter_order, step, filter, before, others): a row per step of each order, 600 in all."""
    rows = []
    for order in permutations(FILTERS):
        for k, f in enumerate(order):
            before = sum(1 << FILTERS.index(g) for g in order[:k])
            rows.append((len(rows), "".join(order), k + 1, f, before, (1 << len(FILTERS)) - 1 - (1 << FILTERS.index(f))))
    return spark.createDataFrame(rows, "o int, filter_order string, step int, filter string, before int, others int")


def filter_audit(docs: DataFrame, labels: DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """What each step of each of the 120 orders of five filters does to each part of ``docs``.

    Filters: A under 200 words; B fewer than half of the words distinct; C over 3 % of the characters in A-Z; D any
    of ``#$%&*|``; E equal to the text of a smaller doc_id, wherever that is. Returns part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost and shapley, zeros included, as the query contract has them.

    A null text is empty, a null part the empty string. Every row counts as a document, also where a doc_id repeats; a null doc_id is neither
    smaller nor larger than another and has no label; of several labels of one id any that is set counts. No rows give no parts.
    Words are told apart by 64-bit hashes, texts by 128 bits.
    """
    spark = docs.sparkSession
    rows, fails = failing_ids(docs, labels, id_col=id_col, text_col=text_col, part_col=part_col)
    counts = store(prefix_counts(fails), "audit-prefixes")
    totals = rows.groupBy("part").agg(F.count(F.lit(1)).alias("total"))
    orders = _orders(spark)  # 600 rows
    grid = totals.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(599)))).join(F.broadcast(orders), "o")
    alone = counts.select("part", "filter", F.col("before").alias("others"), F.col("removed").alias("unique_fails"))
    steps = grid.join(counts, ["part", "filter", "before"], "left").join(alone, ["part", "filter", "others"], "left")
    steps = steps.na.fill(0, ["removed", "redundant", "good_lost", "toxic_lost", "unique_fails"])
    gone = F.sum("removed").over(Window.partitionBy("part", "filter_order").orderBy("step"))
    fair = F.sum("removed").over(Window.partitionBy("part", "filter"))
    return steps.select(
        "part", "filter_order", "step", (F.col("total") - gone).alias("kept"), "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", fair.alias("shapley")
    )


#: The same in DuckDB: documents by the set of filters that they fail, then every step of every order.
SQL = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        concat(CASE WHEN len(words) < 200 THEN 'A' ELSE '' END,
               CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END,
               CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END,
               CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END,
               CASE WHEN doc_id > first_id THEN 'E' ELSE '' END) AS fails
    FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step::INTEGER AS step, substr(filter_order, step::INT, 1) AS f, substr(filter_order, 1, step::INT - 1) AS before
    FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, f,
        sum(CASE WHEN contains(fails, f) AND translate(fails, before, '') = fails THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN contains(fails, f) AND translate(fails, before, '') <> fails THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN fails = f THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN contains(fails, f) AND translate(fails, before, '') = fails THEN good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN contains(fails, f) AND translate(fails, before, '') = fails THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
        sum(CASE WHEN translate(fails, before || f, '') = fails THEN n ELSE 0 END)::BIGINT AS kept
    FROM c, s GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM r
"""
