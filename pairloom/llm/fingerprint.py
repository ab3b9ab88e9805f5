"""Document fingerprints: hashes below a fixed share of the hash range."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import text_shingles

#: Share of all shingle hashes that a fingerprint keeps: 1 in ONE_IN. Short texts need a large share: of n shingles none is kept
#: with a probability of 2^-n, and a share of p in another text is read off with a deviation of sqrt(2 p (1 - p) / n).
ONE_IN = 2
_FIRST = -(2**63)
#: Bytes of text that one task takes.
_TASK_BYTES = 32 << 20


def fingerprints(texts: pa.Array, words: int = 5, one_in: int = ONE_IN) -> Iterator[np.ndarray]:
    """Per text the shingle hashes below 2^64 / one_in.

    Which hashes are kept does not depend on the text's length: the fingerprint of a union is the
    union of the fingerprints (``merge``), and containment can be read off between texts of any sizes.
    """
    limit = np.uint64(2**64 // one_in)
    for values in text_shingles(texts, words):
        yield values[: int(np.searchsorted(values, limit))]


def written(values: np.ndarray) -> str:
    """A fingerprint as text: its hashes, ascending, 16 hexadecimal digits each."""
    return values.astype(">u8").tobytes().hex()


def read(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64)


def merge(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The fingerprint of two texts' shingles together."""
    return np.union1d(x, y)


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Estimated share of the smaller text's shingles that the other holds, 0 to 1; two empty fingerprints are alike, an empty and another are not."""
    least = min(len(x), len(y))
    if not least:
        return float(len(x) == len(y))
    return len(np.intersect1d(x, y, assume_unique=True)) / least


def _placed_keys(spark: SparkSession, parts: int) -> np.ndarray:
    """For each partition a number that a shuffle into ``parts`` partitions sends there, so that buckets do not fall together."""
    tried = spark.range(40 * parts + 400).select("id", F.pmod(F.hash("id"), F.lit(parts)).alias("part"))
    found = {r["part"]: r["id"] for r in tried.groupBy("part").agg(F.min("id").alias("id")).collect()}  # a row per partition
    return np.array([found.get(p, p) for p in range(parts)], np.int64)


def _neighbours(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows dealt to buckets by descending id and sorted in them, each bucket closed by the row that follows it.

    Bounds come from the ids alone, as many as the bytes of all texts ask for. An id that fills several buckets is cut by a hash of the text, by which
    rows of one id are ordered. The first row of a bucket also goes, as a guest, to the bucket
    before it, and the first row of all to the last bucket; so a text is moved once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumns({"id": F.coalesce("doc_id", F.lit(_FIRST)), "h": F.xxhash64("text")})
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0)).alias("b")).first()["b"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // _TASK_BYTES))
    cuts = rows.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)] or [0.5], 10 * max(parts, 1000))).first()[0]
    bounds = np.sort(np.array(cuts or [], np.int64))  # ids up to a bound lie below it

    def bucket_of(x: np.ndarray, h: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(bounds, x, "left"), np.searchsorted(bounds, x, "right")
        share = ((h >> 32) + (1 << 31)) / float(1 << 32)  # 0 to 1 by the hash
        return len(bounds) - low - np.floor(share * np.maximum(high - low, 1)).astype(np.int64)

    def bucket(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        return pa.array(bucket_of(ids.to_numpy(), hashes.to_numpy()).astype(np.int32))

    slim = rows.select("id", "h", F.arrow_udf(bucket, "int")("id", "h").alias("b"))
    heads = {r["b"]: (r["top"]["id"], r["top"]["h"]) for r in slim.groupBy("b").agg(F.max(F.struct("id", "h")).alias("top")).collect()}
    order = sorted(heads)  # one entry per bucket
    guest_of = {heads[b]: order[k - 1] for k, b in enumerate(order)}
    keys = _placed_keys(spark, parts)

    def places(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        x, h = ids.to_numpy(), hashes.to_numpy()
        own = bucket_of(x, h).tolist()
        return pa.array([[b, guest_of[k]] if k in guest_of else [b] for k, b in zip(zip(x.tolist(), h.tolist()), own)], pa.list_(pa.int32()))

    def key(buckets: pa.Array) -> pa.Array:
        return pa.array(keys[buckets.to_numpy() % len(keys)])

    dealt = rows.select("doc_id", "id", "h", "text", F.posexplode(F.arrow_udf(places, "array<int>")("id", "h")).alias("guest", "bucket"))
    dealt = dealt.withColumn("key", F.arrow_udf(key, "bigint")("bucket"))
    return dealt.repartition(parts, "key").sortWithinPartitions("bucket", "guest", F.desc("id"), F.desc("h"), "text").select("doc_id", "text", "guest", "bucket")


def fingerprint_edits(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, one_in: int = ONE_IN) -> DataFrame:
    """Fingerprints of every text and of an edited form of it, with their likeness.

    The edited text has its last floor(n_chars / 3) code points replaced by the first as many (or all) of the next
    document in descending doc_id; after the last comes the first again. Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited (own against edited) and near_next (own against next).

    A null text is empty: it has the empty fingerprint, as a blank one has. A null doc_id comes after all
    others; rows with the same doc_id follow by a hash of the text, descending; a single row is its own next.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row of the batch before, if its next is still to come
        for batch in batches:
            ids, texts, guest, bucket = (batch.column(c).to_pylist() for c in ("doc_id", "text", "guest", "bucket"))
            if held:
                ids, texts, guest, bucket = ([h, *own] for h, own in zip(held, (ids, texts, guest, bucket)))
            for b in range(0, len(ids) - 1, 256):
                yield _compared(ids[b : b + 257], texts[b : b + 257], guest[b : b + 257], words, one_in)
            held = (ids[-1], texts[-1], guest[-1], bucket[-1]) if ids else None

    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return _neighbours(docs, id_col, text_col).mapInArrow(scan, schema)


def _compared(ids: list, texts: list[str], guest: list[int], words: int, one_in: int) -> pa.RecordBatch:
    """Results of all rows but the last and the guests; each row's next is the row after it."""
    own = [k for k in range(len(ids) - 1) if not guest[k]]
    edited = []
    for k in own:
        cut = len(texts[k]) // 3
        edited.append(texts[k][: len(texts[k]) - cut] + texts[k + 1][:cut])
    prints = list(fingerprints(pa.array(texts, pa.string()), words, one_in))
    changed = list(fingerprints(pa.array(edited, pa.string()), words, one_in))
    columns = [
        pa.array([ids[k] for k in own], pa.int64()),
        pa.array([len(texts[k]) for k in own], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
        pa.array([written(prints[k]) for k in own], pa.string()),
        pa.array([written(c) for c in changed], pa.string()),
        pa.array([likeness(prints[k], c) for k, c in zip(own, changed)], pa.float64()),
        pa.array([likeness(prints[k], prints[k + 1]) for k in own], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
