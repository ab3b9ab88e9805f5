"""Exact top-k search by inner product with multi-resolution segment statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.joins import BROADCAST_BYTES
from ..session import store

SCALE = 1024
BLOCK_ROWS = 2048
QUERY_ROWS = 256
#: Numbers of segments, coarse to fine; vectors are padded with zeros to a multiple of the last.
LEVELS = (4, 8, 16)


def scaled(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(row, vec_id, v): floor(scale * x) of every component. Rows with a null id, a null vector or a
    null or non-finite component take no part."""
    v = F.col(vector_col)
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    ready = vectors.filter(F.col(id_col).isNotNull() & v.isNotNull()).filter(sound)
    return ready.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v"),
    )


def _matrix(rows: list) -> np.ndarray:
    """One padded row per vector; a shorter vector counts as zero beyond its end."""
    width = max((len(v) for v in rows), default=0)
    width = -(-max(width, 1) // LEVELS[-1]) * LEVELS[-1]
    out = np.zeros((len(rows), width), np.int64)
    for k, v in enumerate(rows):
        out[k, : len(v)] = v
    return out


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))


def _statistics(m: np.ndarray, segments: int) -> np.ndarray:
    """Per vector sqrt(length) times the mean and the deviation of each segment, side by side."""
    part = m.reshape(len(m), segments, -1)
    length = part.shape[2]
    mean = part.mean(axis=2)
    return np.concatenate([mean, np.sqrt(np.maximum((part.astype(float) ** 2).mean(axis=2) - mean**2, 0))], axis=1) * np.sqrt(length)


def exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products as integers; by floating point where that is exact."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[-1]
    if most < 2**53:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    return q @ x.T


def best_in_block(q: np.ndarray, own: np.ndarray, floor: np.ndarray, x: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its up to k best candidates of a block that may still reach ``floor``.

    With segment means m and deviations s, the squared distance is at least the sum over segments of
    length * ((m - m')^2 + (s - s')^2), so the inner product, half of (norms - distance), is at
    most the sum of length * (m m' + s s'). Each finer level is asked only for what the coarser one
    leaves; the survivors of the last get their exact product.
    """
    q, x = _same_width(q, x)
    alive = rows[None, :] != own[:, None]
    keep = np.arange(len(x))
    for segments in LEVELS:
        bound = _statistics(q, segments) @ _statistics(x[keep], segments).T
        bound += 1e-6 * (1 + np.abs(bound))
        alive[:, keep] &= bound >= floor[:, None]
        keep = np.flatnonzero(alive.any(axis=0))
        if not len(keep):
            return
    score = exact_products(q, x[keep])
    for i in range(len(q)):
        hit = np.flatnonzero(alive[i, keep])
        if len(hit) > k:
            least = np.partition(score[i, hit], len(hit) - k)[len(hit) - k]
            hit = hit[score[i, hit] >= least]
        order = np.lexsort((ids[keep[hit]], -score[i, hit]))[:k]
        if len(order):
            yield i, score[i, hit[order]], ids[keep[hit[order]]]


def _blocks(table: DataFrame, size: int) -> DataFrame:
    """Rows packed into blocks: (block, rows, ids, m, width) with int64 arrays as bytes."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in range(0, len(batch), size):
                part = batch.iloc[b : b + size]
                m = _matrix(part["v"].tolist())
                yield pd.DataFrame(
                    {"rows": [part["row"].to_numpy(np.int64).tobytes()], "ids": [part["vec_id"].to_numpy(np.int64).tobytes()], "m": [m.tobytes()], "width": [m.shape[1]]}
                )

    return table.select("row", "vec_id", "v").mapInPandas(scan, "rows binary, ids binary, m binary, width int")


def _open(row, prefix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, ids = (np.frombuffer(row[prefix + c], np.int64) for c in ("rows", "ids"))
    return rows, ids, np.frombuffer(row[prefix + "m"], np.int64).reshape(len(rows), row[prefix + "width"])


def top_k(queries: DataFrame, base: DataFrame, k: int = 10, *, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``base`` for every row of ``queries``.

    Both are tables as ``scaled`` makes them, (row, vec_id, v); a query does not find the base row with its own
    row number. Score is the integer inner product; equal scores go to the smaller vec_id. A query with fewer
    than k candidates gets all; no candidates or no queries give no rows. Vectors of different lengths are compared
    as if the shorter ended in zeros. Rows that repeat a vec_id are candidates each.

    Base rows stay in blocks where they are; every block meets every block of queries in a task of its own and
    gives out at most k rows per query, after a first block has set each query a score to reach.
    """
    spark = base.sparkSession
    n = queries.count()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    parts = -(-n // query_rows)
    spread = queries.withColumn("qb", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        m = _matrix(rows["v"].tolist())
        return pd.DataFrame(
            {"qb": [rows["qb"].iloc[0]], "rows": [rows["row"].to_numpy(np.int64).tobytes()], "ids": [rows["vec_id"].to_numpy(np.int64).tobytes()], "m": [m.tobytes()], "width": [m.shape[1]]}
        )

    asked = spread.groupBy("qb").applyInPandas(gather, "qb int, rows binary, ids binary, m binary, width int")
    blocks = store(_blocks(base, block_rows), "vector-blocks")
    first = blocks.limit(1)  # one block of at most block_rows rows

    def set_floor(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            floors = []
            for _, row in batch.iterrows():
                own, _, q = _open(row)
                rows, _, x = _open(row, "x_")
                score = exact_products(*_same_width(q, x)).astype(float)
                score[rows[None, :] == own[:, None]] = -np.inf
                floors.append((np.partition(score, -k, axis=1)[:, -k] if score.shape[1] >= k else np.full(len(q), -np.inf)).tobytes())
            yield batch[["qb", "rows", "ids", "m", "width"]].assign(floor=floors)

    schema = "qb int, rows binary, ids binary, m binary, width int, floor binary"
    seeds = first.select(*[F.col(c).alias("x_" + c) for c in ("rows", "ids", "m", "width")], F.lit(1).alias("one"))
    asked = store(asked.withColumn("one", F.lit(1)).join(F.broadcast(seeds), "one").drop("one").mapInPandas(set_floor, schema), "query-blocks")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                own, query_ids, q = _open(row)
                rows, ids, x = _open(row, "x_")
                for i, score, found in best_in_block(q, own, np.frombuffer(row["floor"]), x, rows, ids, k):
                    yield pd.DataFrame({"q": own[i], "query_id": query_ids[i], "vec_id": found, "score": score})

    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("qb")
    meetings = blocks.select(*[F.col(c).alias("x_" + c) for c in ("rows", "ids", "m", "width")], every)
    # blocks of queries are sent to every executor only if their bytes, vectors included, are few
    size = asked.agg(F.coalesce(F.sum(F.octet_length("m").cast("bigint") + F.octet_length("floor")), F.lit(0)).alias("b")).first()["b"]
    side = F.broadcast(asked) if size <= BROADCAST_BYTES else asked
    found = meetings.join(side, "qb").mapInPandas(search, "q bigint, query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def search_self(vectors: DataFrame, *, every: int = 100, k: int = 10, **columns) -> DataFrame:
    """``top_k`` of the rows whose id is divisible by ``every`` among all other rows of the same table."""
    ready = store(scaled(vectors, **columns), "vectors")
    return top_k(ready.filter(F.col("vec_id") % every == 0), ready, k)


#: The same in DuckDB, for tables without null or non-finite components.
SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) e FROM embeddings),
s AS (SELECT q.vec_id query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
