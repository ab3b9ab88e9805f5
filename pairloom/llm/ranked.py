"""Ranked lexical search: documents grouped by the mask of matched terms, masks evaluated from the best bound down."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import store
from .common import BYTE_VALUE, LOWER, row_runs, text_view
from .runs import byte_class, run_hashes

#: Terms are runs of ASCII letters and digits and of all characters beyond ASCII.
TERM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Documents of one block, at most, and bits of a block's bitmaps.
BLOCK_DOCS, BITMAP_BITS = 4096, 1 << 29
#: Items are searched together up to about so many terms; more of them take further passes over the documents.
PASS_TERMS = 1 << 16
#: Documents whose exact scores are taken first; each further step takes twice as many.
FIRST_STEP = 32

_BLOCK = "ids array<bigint>, n binary, terms binary, sizes binary, places binary, tf binary, n_docs bigint, n_terms bigint"
_FOLDED = BYTE_VALUE[LOWER]


def item_terms(items: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """(item_id, term): the distinct term hashes of every item; rows with one id are one item."""

    def terms(texts: pa.Array) -> pa.Array:
        data, offsets = text_view(texts)
        parts = []
        for i, j in row_runs(offsets):
            hashes, rows = run_hashes(data, offsets, i, j, TERM, _FOLDED)
            ends = np.searchsorted(rows, np.arange(j - i + 1))
            parts += [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(ends[:-1], ends[1:])]
        return pa.array(parts, pa.list_(pa.int64()))

    each = items.select(F.col(id_col).cast("bigint").alias("item_id"), F.arrow_udf(terms, "array<bigint>")(F.col(text_col)).alias("t"))
    return each.select("item_id", F.explode("t").alias("term")).distinct()


def _block(held: list, asked: int) -> pa.RecordBatch:
    """One row for some documents: lengths, and for each asked term that occurs its documents (ascending) and its counts in them."""
    ids = pa.concat_arrays([h[0] for h in held])
    n = np.concatenate([h[1] for h in held])
    shift = np.cumsum([0] + [len(h[1]) for h in held])
    key = np.concatenate([h[2] + s for h, s in zip(held, shift)])  # term * BLOCK_DOCS + document, so parts are merged by sorting
    tf = np.concatenate([h[3] for h in held])
    order = np.argsort(key, kind="stable")
    term, place = np.divmod(key[order], BLOCK_DOCS)
    terms, sizes = np.unique(term, return_counts=True)
    some = int((n > 0).sum())
    columns = [
        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
        *(pa.array([x.tobytes()], pa.binary()) for x in (n, terms, sizes, place.astype(np.uint16), tf[order])),
        pa.array([some]),
        pa.array([int(n.sum())]),
    ]
    return pa.RecordBatch.from_arrays(columns, ["ids", "n", "terms", "sizes", "places", "tf", "n_docs", "n_terms"])


def blocks_of(docs: DataFrame, asked: np.ndarray, block_docs: int) -> DataFrame:
    """Rows of (doc_id, text) as blocks of at most ``block_docs`` documents with the places of the ``asked`` terms (hashes, ascending)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs_held = [], 0
        for batch in batches:
            data, offsets = text_view(batch.column(1))
            for i, j in row_runs(offsets):
                for a in range(i, j, block_docs):
                    b = min(a + block_docs, j)
                    if docs_held + b - a > block_docs:
                        yield _block(held, len(asked))
                        held, docs_held = [], 0
                    hashes, rows = run_hashes(data, offsets, a, b, TERM, _FOLDED)
                    n = np.bincount(rows, minlength=b - a).astype(np.int64)
                    at = np.searchsorted(asked, hashes)
                    hit = np.flatnonzero(asked[np.minimum(at, len(asked) - 1)] == hashes)
                    key, tf = np.unique(at[hit] * BLOCK_DOCS + rows[hit], return_counts=True)
                    held.append((batch.column(0).slice(a, b - a), n, key, tf.astype(np.int32)))
                    docs_held += b - a
        if held:
            yield _block(held, len(asked))

    return docs.select("doc_id", "text").mapInArrow(scan, _BLOCK)


def _document_counts(blocks: DataFrame) -> DataFrame:
    """(term number, df): documents of each term, added up in the tasks first."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for raw_terms, raw_sizes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                terms, sizes = np.frombuffer(raw_terms, np.int64), np.frombuffer(raw_sizes, np.int64)
                if len(terms) and terms[-1] >= len(total):
                    total = np.pad(total, (0, int(terms[-1]) + 1 - len(total)))
                total[terms] += sizes
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    return blocks.select("terms", "sizes").mapInArrow(scan, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))


class Block:
    """The documents of one block, with what every posting adds to its document's score and a bitmap per term."""

    def __init__(self, row: dict, weight: np.ndarray, n_docs: int, n_terms: int):
        self.ids = row["ids"]
        n, self.terms, sizes = (np.frombuffer(row[c], np.int64) for c in ("n", "terms", "sizes"))
        self.place = np.frombuffer(row["places"], np.uint16).astype(np.int64)
        tf = np.frombuffer(row["tf"], np.int32).astype(np.int64)
        self.ends = np.concatenate([[0], np.cumsum(sizes)])
        m = 10 + (90 * n * n_docs) // max(n_terms, 1)
        own = np.repeat(np.arange(len(self.terms)), sizes)
        self.adds = weight[self.terms][own] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[self.place]))
        self.most = np.maximum.reduceat(self.adds, self.ends[:-1]) if len(self.adds) else np.zeros(0, np.int64)
        self.maps = np.zeros((len(self.terms), -(-len(n) // 8)), np.uint8)
        np.bitwise_or.at(self.maps, (own, self.place >> 3), (128 >> (self.place & 7)).astype(np.uint8))

    def masks(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents grouped by which of the terms ``rows`` they hold: the distinct masks (masks x terms) and each document's mask."""
        bits = np.unpackbits(self.maps[rows], axis=1, count=len(self.ids))
        words = np.packbits(bits, axis=0)
        words = np.pad(words, ((0, -len(words) % 8), (0, 0)))
        key = np.ascontiguousarray(words.T)
        if key.shape[1] == 8:
            _, first, group = np.unique(key.view(np.uint64).ravel(), return_index=True, return_inverse=True)
        else:
            _, first, group = np.unique(key.view(f"V{key.shape[1]}").ravel(), return_index=True, return_inverse=True)
        return bits[:, first].T, group

    def scores(self, rows: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Exact scores of the documents (ascending places)."""
        out = np.zeros(len(docs), np.int64)
        for r in rows.tolist():
            a, b = self.ends[r], self.ends[r + 1]
            at = np.minimum(np.searchsorted(self.place[a:b], docs), b - a - 1)
            hit = self.place[a:b][at] == docs
            out[hit] += self.adds[a:b][at[hit]]
        return out

    def search(self, terms: np.ndarray, k: int, best: list[tuple[int, bool, int]]) -> list[tuple[int, bool, int]]:
        """The k best of ``best`` and of the block, as (-score, no id, id).

        A mask's bound is the sum of the most that its terms add anywhere in the block. Masks are taken from the highest
        bound down until the k-th score so far is above the next bound; equal ones still count, for their ids.
        """
        rows = np.flatnonzero(np.isin(self.terms, terms, assume_unique=True))
        rows = rows[self.most[rows] > 0]
        if not len(rows) or (len(best) == k and int(self.most[rows].sum()) < -best[-1][0]):
            return best
        held, group = self.masks(rows)
        bound = held.astype(np.int64) @ self.most[rows]
        order = np.argsort(-bound, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        docs = np.argsort(rank[group], kind="stable")
        upto = np.searchsorted(rank[group][docs], np.arange(len(order)), "right")  # documents of the first masks
        mask, step, done = 0, FIRST_STEP, 0
        while mask < len(order) and bound[order[mask]] > 0 and not (len(best) == k and -best[-1][0] > bound[order[mask]]):
            mask = max(mask + 1, int(np.searchsorted(upto, done + step, "right")))
            some = np.sort(docs[done : upto[mask - 1]])
            score = self.scores(rows, some)
            floor = -best[-1][0] if len(best) == k else 1
            good = np.flatnonzero(score >= floor)
            found = [(-int(score[g]), self.ids[some[g]] is None, self.ids[some[g]] or 0) for g in good.tolist()]
            best = heapq.nsmallest(k, [*best, *found])
            done, step = int(upto[mask - 1]), 2 * step
        return best


def _searched(blocks: DataFrame, items: list[tuple[int | None, np.ndarray]], weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    sent = blocks.sparkSession.sparkContext.broadcast((items, weight))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = sent.value
        best: list[list[tuple[int, bool, int]]] = [[] for _ in items]
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, weight, n_docs, n_terms)
                for q, (_, terms) in enumerate(items):
                    best[q] = block.search(terms, k, best[q])
        rows = [(items[q][0], None if none else d, -s) for q, own in enumerate(best) for s, none, d in own]
        columns = zip(*rows) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])

    return blocks.drop("n_docs", "n_terms").mapInArrow(scan, "item_id bigint, doc_id bigint, score bigint")


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 10, *, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", pass_terms: int = PASS_TERMS, block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents with a score above 0 for every item.

    Terms, weights and scores are those of the query contract: integer tf-idf with saturation by document length, over the
    distinct terms of the item. Equal scores go to the smaller doc_id. Fewer than k documents with a score give them all; an item without
    terms, or none of whose terms occurs, has no row. A null or empty text has no terms and does not count as a document.
    Rows that repeat a doc_id are documents each; a null doc_id is kept and comes last among equals; rows of one item_id (or without one)
    are one item. Terms are told apart by 64-bit hashes.

    One scan turns the documents into stored blocks that hold the asked terms alone, from which document counts are summed. Then every block
    is searched for every item of the pass, with the item's k best so far as the floor; a task gives out k rows an item.
    Items are taken in passes of about ``pass_terms`` terms, so what is sent to the tasks is bounded.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    asked = store(item_terms(items, id_col=item_id, text_col=item_text), "search-terms")
    passes = max(1, math.ceil(asked.count() / pass_terms))
    found = spark.createDataFrame([], "item_id bigint, doc_id bigint, score bigint")
    for p in range(passes):
        own = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == p).groupBy("item_id").agg(F.collect_list("term").alias("t"))
        sets = [(r["item_id"], np.array(r["t"], np.int64).view(np.uint64)) for r in own.collect()]  # about pass_terms numbers
        if not sets:
            continue
        terms = np.unique(np.concatenate([t for _, t in sets]))
        numbered = [(i, np.searchsorted(terms, np.sort(t))) for i, t in sets]
        size = int(min(block_docs, BLOCK_DOCS, max(256, BITMAP_BITS // len(terms))))
        blocks = store(blocks_of(rows, terms, size), "search-blocks")
        sums = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("l")).first()
        weight = np.zeros(len(terms), np.int64)
        for r in _document_counts(blocks).collect():  # a row per term of the pass
            weight[r["term"]] = math.floor(1000 * math.log((2 * sums["n"] + 2) / (2 * r["df"] + 1)))
        found = found.unionByName(_searched(blocks, numbered, weight, sums["n"], sums["l"], k))
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


#: The same in DuckDB.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
p AS (SELECT r, doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM d),
f AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*)::BIGINT AS tf FROM p WHERE term IN (SELECT term FROM i) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM f, s GROUP BY term, n_docs),
g AS (SELECT i.item_id, f.r, any_value(f.doc_id) AS doc_id,
        sum(w.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM i JOIN f USING (term) JOIN w USING (term), s GROUP BY i.item_id, f.r)
SELECT item_id, rank, doc_id, score FROM (
    SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM g WHERE score > 0)
WHERE rank <= 10
"""
