"""MinHash near-duplicates with bottom-k sketches from one hash function."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.joins import fits_broadcast
from ..session import store, temporary
from .common import lists_of, mix, text_shingles
from .graph import components, linked_by_keys

#: Size of a sketch, and how many values two sketches must share to be compared. With a true
#: similarity of 0.85 the shared number is at least binomial(64, 0.85), mean 54, deviation 2.9:
#: fewer than 36 comes with a probability below 1e-7; with 0.8, below 2e-5.
SKETCH = 64
SHARED = 36


def signatures(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, k: int = SKETCH) -> DataFrame:
    """Per row: number of distinct shingles, a 128-bit digest of the shingle set and its k smallest hashes.

    Lower-cases A-Z; words are runs of bytes other than 0x20 and 0x09-0x0D. A text with
    fewer than ``words`` words is one shingle; a null, empty or blank text has none.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, c1, c2, low = [], [], [], []
            for values in text_shingles(batch.column(1), words):
                sizes.append(len(values))
                c1.append(int(mix(values).sum(dtype=np.uint64).view(np.int64)) if len(values) else 0)
                c2.append(int(mix(values ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)) if len(values) else 0)
                low.append(values[:k])
            columns = [batch.column(0), batch.column(2), batch.column(3), pa.array(sizes, pa.int64()), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()), lists_of(low, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "t1", "t2", "n_shingles", "c1", "c2", "sketch"])

    out = _keyed(docs, id_col, text_col).mapInArrow(scan, "doc_id bigint, t1 bigint, t2 bigint, n_shingles bigint, c1 bigint, c2 bigint, sketch array<bigint>")
    return out.select(F.monotonically_increasing_id().alias("row"), "*")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and a key of the text by which a later scan finds it again."""
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        text.alias("text"),
        F.xxhash64(text).alias("t1"),
        F.xxhash64(F.lit(1), F.octet_length(text), text).alias("t2"),
    )


def _alike(k: int, least: float):
    """Estimate from the k smallest values of the union of two sketches."""

    def alike(x: np.ndarray, ys: list[np.ndarray]) -> np.ndarray:
        x = x.view(np.uint64)
        out = np.zeros(len(ys), bool)
        for i, y in enumerate(ys):
            both = np.sort(np.concatenate([x, y.view(np.uint64)]))
            twice = both[1:] == both[:-1]
            # the k smallest distinct values of the union
            union = len(both) - int(twice.sum())
            if union > k:
                new = np.concatenate([[True], ~twice])
                end = int(np.searchsorted(np.cumsum(new), k, "right"))
                twice, union = twice[: end - 1], k
            out[i] = twice.sum() >= least * union
        return out

    return alike


def _overlap(similarity: int, words: int):
    """Exact test on the full shingle sets of two text columns."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(text_shingles(batch.column(2), words), text_shingles(batch.column(3), words)):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= similarity * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return scan


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    similarity: int = 85,
    k: int = SKETCH,
    shared: int = SHARED,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id and kept; besides, a row number, the
    group's node (root; null without shingles) and two hashes of the text (t1, t2).

    Texts are linked when 100 * intersection >= similarity * union holds for their
    sets of distinct word shingles; component_id is the smallest doc_id that can be reached.

    Method. One hash function gives every text the k smallest hashes of its shingles
    (bottom-k sketch). Equal sets fall into one class first and go on as one node.
    Each node keeps, of its retained values, those that are rarest in the corpus: two
    sketches that share at least ``shared`` values share one of each other's first
    k - shared + 1 in that order, so the inverted lists of these values alone give all
    candidates, and a passage that many texts share fills no list. The union of two
    sketches gives an estimate that drops unlike candidates; the full sets of the rest
    are compared exactly; union of links gives the components.

    Defined results: null, empty and blank texts have no shingles, link with nothing and are
    their own component. Repeated rows are equal texts: they share a component. A null doc_id
    counts as larger than all others; kept is doc_id = component_id, so rows that repeat the
    smallest doc_id are all kept, and in a component without any doc_id, all with null.
    """
    rows = store(signatures(docs, id_col=id_col, text_col=text_col, words=words, k=k), "signatures")
    classes = store(
        rows.filter("n_shingles > 0")
        .groupBy("c1", "c2")
        .agg(F.min(F.struct("row", "doc_id", "t1", "t2")).alias("one"), F.first("sketch").alias("sketch"))
        .select("c1", "c2", F.col("one.row").alias("node"), F.struct("one.doc_id", "one.t1", "one.t2").alias("source"), "sketch"),
        "shingle-classes",
    )
    links = _links(docs, classes, id_col, text_col, words, similarity, k, shared)
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    member = classes.join(roots, "node", "left").select("c1", "c2", F.coalesce("root", "node").alias("root"))
    placed = rows.select("row", "doc_id", "t1", "t2", "n_shingles", "c1", "c2").join(member, ["c1", "c2"], "left")
    # a text without shingles is alone
    placed = placed.select("row", "doc_id", "t1", "t2", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("root")).alias("root"))
    placed = store(placed, "placed")
    lowest = placed.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("lowest"))
    out = placed.join(lowest, "root", "left").withColumn(
        "component_id", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("lowest"))
    )
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return out.select("doc_id", "n_shingles", "component_id", kept, "row", "root", "t1", "t2")


def _links(docs, classes, id_col, text_col, words, similarity, k, shared):
    values = classes.select("node", F.explode("sketch").alias("key"))
    common = values.groupBy("key").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    found = values.join(common, "key")
    # a sketch below k values is the whole set: the pair must share similarity / 100 of it
    sizes = classes.select("node", F.size("sketch").alias("kept_values"))
    need = F.least(F.lit(shared), F.expr(f"int((kept_values * {similarity} + 99) div 100)"))
    order = Window.partitionBy("node").orderBy("df", "key")
    ranked = found.withColumn("at", F.row_number().over(order)).withColumn("of", F.count(F.lit(1)).over(Window.partitionBy("node")))
    # values of one node only are rarer than all others: they fill the first places
    prefix = ranked.join(sizes, "node").filter(F.col("kept_values") - F.col("of") + F.col("at") <= F.col("kept_values") - need + 1)
    postings = store(prefix.select("key", "node"), "postings")

    wanted = classes.join(postings.select("node").distinct(), "node").select("node", "source.*")
    texts = store(_texts_of(docs, store(wanted, "candidates"), id_col, text_col), "candidate-texts")
    payload = classes.select("node", "sketch")
    exact = _overlap(similarity, words)

    def verify(pairs: DataFrame) -> DataFrame:
        left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
        right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
        return both.mapInArrow(exact, "a bigint, b bigint")

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in range(0, batch.num_rows, 256):
                part = batch.slice(b, 256)
                values = lists_of(list(text_shingles(part.column(1), words)), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), values], ["node", "members"])

    def sets(nodes: DataFrame) -> DataFrame:
        return texts.join(nodes, "node").select("node", "text").mapInArrow(full_sets, "node bigint, members array<bigint>")

    def linked(both: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return 100 * both >= similarity * (x + y - both)

    # the estimate may be off by as much as the shared number allows for
    return linked_by_keys(postings, verify, sets, linked, payload, _alike(k, shared / k))


def _texts_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, text) of the wanted rows, found by doc_id and text key in a second scan.

    Few wanted rows (measured) go to the scan as a broadcast; otherwise both sides are shuffled.
    """
    side = wanted.select("node", F.col("doc_id").alias("w"), F.col("t1").alias("w1"), F.col("t2").alias("w2"))
    side = F.broadcast(side) if fits_broadcast(wanted) else side
    keyed = _keyed(docs, id_col, text_col)
    same = (F.col("t1") == F.col("w1")) & (F.col("t2") == F.col("w2")) & F.col("doc_id").eqNullSafe(F.col("w"))
    return keyed.join(side, same).select("node", "text").dropDuplicates(["node"])


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, of which one in each group of near-duplicates stays.

    The one with the smallest doc_id stays (a null counts as larger), of rows that repeat it the one with the smallest text key,
    and of wholly repeated rows one. Texts without shingles are in no group and all stay.
    """
    with temporary("near-fate"):
        fate = _fate(near_duplicates(docs, id_col=id_col, text_col=text_col, **options))
    text = F.col(text_col)
    keyed = docs.withColumns({"__k1": F.xxhash64(text), "__k2": F.xxhash64(F.lit(1), F.octet_length(text), text)})
    same = F.col(id_col).cast("bigint").eqNullSafe(F.col("__id")) & (F.col("__k1") == F.col("__t1")) & (F.col("__k2") == F.col("__t2"))
    side = F.broadcast(fate) if fits_broadcast(fate) else fate
    joined = keyed.join(side, same, "left").filter("__one is null or __one")
    single = joined.filter("__one is null")
    # rows that repeat the chosen doc_id and text: one of them
    again = joined.filter("__one").dropDuplicates(["__id", "__t1", "__t2"])
    return single.union(again).select(*docs.columns)


def _fate(rows: DataFrame) -> DataFrame:
    """(__id, __t1, __t2, __one) for the rows of groups of several: whether one of the rows of these keys stays. Written."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t1", "t2", "row")
    in_group = F.col("root").isNotNull()
    members = rows.filter(in_group).select("root", order.alias("place"), F.struct("doc_id", "t1", "t2").alias("key"))
    best = members.groupBy("root").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("n"))
    # groups of one keep their row; the others give the keys of the rows that go
    several = members.drop("place").join(best.filter("n > 1"), "root")
    chosen = F.struct(F.col("place.doc_id"), F.col("place.t1"), F.col("place.t2"))
    fate = several.select("key", (F.col("key") == chosen).alias("one")).groupBy("key").agg(F.max("one").alias("one"))
    return store(fate.select("key.*", "one").toDF("__id", "__t1", "__t2", "__one"), "near-fate")
