"""Language-model scores by a hashed maximum-entropy model with class-factored softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import store
from .common import mix, row_runs, text_view, word_hashes
from .gam import held_out

ADD = 0.1
#: The token that ends every text; no word has this hash but by a 64-bit accident.
END = np.uint64(0x0E2D0E2D0E2D0E2D)
START = np.uint64(0)
#: Words that are classes of their own, classes of the other words, and parts of each of these.
SINGLE, GROUPS, PARTS = 16, 24, 16
#: Feature tables have one row per hashed feature value: 2^LEAST_BITS to 2^MOST_BITS, with the square root of the training tokens.
LEAST_BITS, MOST_BITS = 10, 18
#: Training tokens of a lane, for each row of a table: a lane is one task's share of the texts.
LANE_TOKENS = 128
#: Passes over disjoint parts of the training texts, with weights averaged after each.
ROUNDS = 2
BATCH = 16_384
RATE = 0.1
#: Frequent words whose counts go to every task; the others are joined.
FREQUENT = 1 << 18
_SLOTS = 21
_TAIL_CONTEXTS = 64
_BLOCK = 64


def tokens(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows: first row, token hashes (each text's words and END), word endings and token counts."""
    data, offsets = text_view(column)
    for i, j in row_runs(offsets):
        tails: list[np.ndarray] = []
        words, counts = word_hashes(data, offsets, i, j, tails)
        ends = np.cumsum(counts)
        hashes = np.insert(words, ends, END)
        tail = np.insert(np.concatenate(tails) if tails else np.zeros(0, np.int64), ends, 0)
        yield i, hashes, tail, counts + 1


def _places(sizes: np.ndarray) -> np.ndarray:
    """Position of each token in its own text."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _back(x: np.ndarray, place: np.ndarray, d: int, start) -> np.ndarray:
    out = np.full(len(x), start, x.dtype)
    out[d:] = x[:-d]
    out[place < d] = start
    return out


def count_tokens(docs: DataFrame) -> DataFrame:
    """(kind, word, tail, n): kind 0 counts tokens of the texts of ``docs``; kind 1 counts word endings
    (tail) by a hash of the ending before (word), at most 65536 * 64 of them."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        follow = np.zeros((1 << 16) * _TAIL_CONTEXTS, np.int64)

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            words, tails, times = (np.concatenate(c) for c in zip(*held))
            words, at, inverse = np.unique(words, return_index=True, return_inverse=True)
            return words, tails[at], np.bincount(inverse, times).astype(np.int64)

        def rows(kind: int, words: np.ndarray, tails: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
            for b in range(0, len(words), 1 << 16):
                e = slice(b, b + (1 << 16))
                columns = [pa.array(np.full(len(words[e]), kind, np.int32)), pa.array(words[e].view(np.int64)), pa.array(tails[e].astype(np.int32)), pa.array(times[e])]
                yield pa.RecordBatch.from_arrays(columns, ["kind", "word", "tail", "n"])

        size = 0
        for batch in batches:
            for _, hashes, tail, sizes in tokens(batch.column(0)):
                words, at, times = np.unique(hashes, return_index=True, return_counts=True)
                held.append((words, tail[at], times))
                before = _back(tail, _places(sizes), 1, 0)
                follow += np.bincount(tail * _TAIL_CONTEXTS + (mix(before.astype(np.uint64)) >> np.uint64(58)).astype(np.int64), minlength=len(follow))
                size += len(words)
                if size > 1 << 20:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > 1 << 19:
                        yield from rows(0, *held[0])
                        held, size = [], 0
        if held:
            yield from rows(0, *merged())
        some = np.flatnonzero(follow)
        yield from rows(1, (some % _TAIL_CONTEXTS).astype(np.uint64), some // _TAIL_CONTEXTS, follow[some])

    counted = docs.select("text").mapInArrow(scan, "kind int, word bigint, tail int, n bigint")
    return counted.groupBy("kind", "word", "tail").agg(F.sum("n").alias("n"))


@dataclass
class Classes:
    """Which class a token is in: frequent words have their own, the rest go by their endings."""

    single: np.ndarray  # sorted hashes
    of_tail: np.ndarray

    @property
    def number(self) -> int:
        return SINGLE + GROUPS

    def of(self, hashes: np.ndarray, tail: np.ndarray) -> np.ndarray:
        k = np.searchsorted(self.single, hashes)
        k[k == len(self.single)] = 0
        own = self.single[k] == hashes if len(self.single) else np.zeros(len(hashes), bool)
        return np.where(own, k, SINGLE + self.of_tail[tail])


def group_endings(tail: np.ndarray, context: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A class for each of the 65536 word endings: clusters of what ending comes before, for the
    1024 commonest endings; a hash for the others."""
    table = np.zeros((1 << 16, _TAIL_CONTEXTS))
    np.add.at(table, (tail, context), n)
    total = table.sum(axis=1)
    common = np.argsort(-total, kind="stable")[:1024]
    common = common[total[common] > 0]
    out = (mix(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(GROUPS)).astype(np.int64)
    if len(common):
        x, weight = np.sqrt(table[common] / total[common][:, None]), total[common]
        centre = x[:GROUPS].copy()
        for _ in range(20):
            near = ((x[:, None] - centre[None]) ** 2).sum(axis=2).argmin(axis=1)
            for c in range(len(centre)):
                if (near == c).any():
                    centre[c] = np.average(x[near == c], axis=0, weights=weight[near == c])
        out[common] = near
    return out


def bits_for(tokens: int) -> int:
    """Table rows grow with the square root of the training tokens, as the number of different words does."""
    return int(np.clip(round(np.log2(max(tokens, 1)) / 2) + 1, LEAST_BITS, MOST_BITS))


def features(hashes: np.ndarray, cls: np.ndarray, place: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the class table and of the part table for each token: n-grams of words and classes, and skips. The part table's
    features are those of the token's class; their last row is that of the class alone."""
    w1, w2 = (_back(hashes, place, d, START) for d in (1, 2))
    c1, c2, c3 = (_back(cls, place, d, 63).astype(np.uint64) for d in (1, 2, 3))
    n = np.uint64(64)
    one, two = mix(w1 + np.uint64(1)), mix(w1 * np.uint64(3) + w2 + np.uint64(2))
    values = (
        one,  # the word before
        two,  # the two words before
        mix(c1 * n + c2 + np.uint64(1 << 40)),  # the two classes before
        mix(c2 * n + c3 + np.uint64(1 << 41)),  # skip: the classes two and three back
        mix((c1 * n + c2) * n + c3 + np.uint64(1 << 42)),  # the three classes before
    )
    own = cls.astype(np.uint64) + np.uint64(1 << 43)
    inner = (mix(one ^ mix(own)), mix(two ^ mix(own)), mix(w2 * np.uint64(5) + mix(own)), mix(own))  # word, two words, skip word, class
    shift = np.uint64(64 - bits)
    return tuple(np.stack([(v >> shift).astype(np.int64) for v in rows]) for rows in (values, inner))


def part_of(hashes: np.ndarray) -> np.ndarray:
    """The part of its class that a word is in."""
    return (mix(hashes ^ np.uint64(0x9A77)) >> np.uint64(60)).astype(np.int64) % PARTS


def probabilities(weights: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Probabilities (outcomes, tokens) of a batch given its feature rows; the last table row is the bias."""
    z = np.take(weights, f[0], axis=1)
    for k in range(1, len(f)):
        z += np.take(weights, f[k], axis=1)
    z += weights[:, -1:]
    z -= z.max(axis=0)
    np.exp(z, out=z)
    z /= z.sum(axis=0)
    return z


def descend(weights: np.ndarray, seen: np.ndarray, power: np.ndarray, f: np.ndarray, y: np.ndarray) -> None:
    """One gradient step of a batch, in place, with a step length per table row that falls as the row's gradients add up."""
    if not len(y):
        return
    g = probabilities(weights, f)
    g[y, np.arange(len(y))] -= 1
    flat, rows = f.ravel(), weights.shape[1]
    if rows > len(flat):  # a batch touches few rows of a large table
        touched, at = np.unique(flat, return_inverse=True)
        touched = np.append(touched, rows - 1)
    else:
        touched, at = slice(None), flat
    n = rows if isinstance(touched, slice) else len(touched)
    step = np.empty((len(g), n), np.float32)
    for c in range(len(g)):
        step[c] = np.bincount(at, np.tile(g[c], len(f)), n)
        step[c, -1] = g[c].sum()
    times = np.bincount(at, minlength=n)
    times[-1] += len(y)
    seen[touched] += times
    power[touched] += (step**2).mean(axis=0)
    weights[:, touched] -= RATE / np.sqrt(power[touched]) * step


def _each_batch(texts: pa.Array, classes: Classes, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for i, hashes, tail, sizes in tokens(texts):
        cls = classes.of(hashes, tail)
        yield i, hashes, cls, *features(hashes, cls, _places(sizes), bits), sizes


def _train_round(lanes: DataFrame, classes: Classes, weights: list[np.ndarray], bits: int) -> DataFrame:
    """(block, lane, body): visit-weighted weights and visits of the table rows, per lane; each lane descends through its texts from the shared weights.

    ``lanes`` is (lane, text), a lane's rows together and in an order of their own, so the result does not depend on files or tasks."""
    shared = lanes.sparkSession.sparkContext.broadcast((vars(classes), weights))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, start = shared.value
        own = Classes(**kind)
        state: dict = {}

        def begin(lane: int) -> None:
            local = [w.copy() for w in start]
            state.update(
                lane=lane, local=local, seen=[np.zeros(w.shape[1]) for w in local], power=[np.full(w.shape[1], 1e-3, np.float32) for w in local], waiting=[], n=0
            )

        def work(least: int) -> None:
            f, g, cls, part = (np.concatenate(c, axis=-1) for c in zip(*state["waiting"]))
            at, n = 0, state["n"]
            while n - at >= least and n > at:
                e = slice(at, at + BATCH)
                descend(state["local"][0], state["seen"][0], state["power"][0], f[:, e], cls[e])
                inner = np.flatnonzero(cls[e] >= SINGLE)
                descend(state["local"][1], state["seen"][1], state["power"][1], g[:, e][:, inner], part[e][inner])
                at = min(at + BATCH, n)
            state["waiting"], state["n"] = [(f[:, at:], g[:, at:], cls[at:], part[at:])], n - at

        def finish() -> Iterator[pa.RecordBatch]:
            if state["n"]:
                work(1)
            for table, (local, seen) in enumerate(zip(state["local"], state["seen"])):
                packed = np.concatenate([local * seen, seen[None]]).astype(np.float32)
                blocks = [b for b in range(0, packed.shape[1], _BLOCK) if packed[-1, b : b + _BLOCK].any()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([table] * len(blocks), pa.int32()), pa.array(np.array(blocks, np.int64)), pa.array([state["lane"]] * len(blocks), pa.int64()), pa.array([packed[:, b : b + _BLOCK].tobytes() for b in blocks], pa.binary())],
                    ["table", "block", "lane", "body"],
                )

        for batch in batches:
            lane = batch.column(0).to_numpy()
            for a, b in zip(*_stretches(lane)):
                if state.get("lane") != int(lane[a]):
                    if state:
                        yield from finish()
                    begin(int(lane[a]))
                for _, hashes, cls, f, g, _ in _each_batch(batch.column(1).slice(a, b - a), own, bits):
                    state["waiting"].append((f, g, cls, part_of(hashes)))
                    state["n"] += len(cls)
                    if state["n"] >= 4 * BATCH:
                        work(BATCH)
        if state:
            yield from finish()

    return lanes.mapInArrow(scan, "table int, block bigint, lane bigint, body binary")


def _stretches(x: np.ndarray) -> tuple[list[int], list[int]]:
    """Where equal neighbours begin and end."""
    cuts = (np.flatnonzero(np.diff(x)) + 1).tolist()
    return [0, *cuts] if len(x) else [], [*cuts, len(x)] if len(x) else []


def _summed(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Add up the bodies of each key (table, block, lane), streaming over rows in the order of ``order``; every task holds one sum at a time."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, None
        for batch in batches:
            for k, key in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
                part = np.frombuffer(batch.column(3)[k].as_py(), np.float32)
                if key == held:
                    total = total + part
                else:
                    if held:
                        yield row(held, total)
                    held, total = key, part.astype(np.float64)
        if held:
            yield row(held, total)

    def row(key: tuple[int, int, int], total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]]), pa.array([key[2]]), pa.array([total.astype(np.float32).tobytes()], pa.binary())], ["table", "block", "lane", "body"])

    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = parts.repartition(n, *keys).sortWithinPartitions(*keys, "order")
    return dealt.select("table", "block", "lane", "body").mapInArrow(scan, "table int, block bigint, lane bigint, body binary")


def _lanes(docs: DataFrame, part: int, rounds: int, lanes: int) -> DataFrame:
    """(lane, text) of one round's texts: each text has its round, lane and place in the lane by hashes of its id and itself."""
    own = F.xxhash64(F.lit(3), "doc_id", "text")
    mine = docs.select("text", own.alias("h")).filter(F.pmod("h", F.lit(rounds)) == part)
    dealt = mine.withColumn("lane", F.pmod(F.xxhash64(F.lit(5), "h"), F.lit(lanes)))
    return dealt.repartition(4 * lanes, "lane").sortWithinPartitions("lane", "h", "text").select("lane", "text")


@dataclass
class Model:
    classes: Classes
    bits: int
    weights: list[np.ndarray]  # of classes, and of the parts of a class
    train_tokens: int
    vocabulary: int
    inside: np.ndarray  # per class and part log10 of the denominator of a word's share in it; 0 for single words
    counts: DataFrame  # (word, n)
    frequent: tuple[np.ndarray, np.ndarray]


def fit(docs: DataFrame, *, rounds: int = ROUNDS) -> Model:
    """Learn from (doc_id, text): counts of all tokens, classes, and class weights by distributed gradient steps.

    Each round goes through its own part of the texts, dealt to lanes by hashes, so that the weights do not depend on files and tasks; every lane
    starts from the shared weights, descends in batches of BATCH tokens, and the rows of the tables are averaged over lanes by how often
    they were visited. The rows grow with the square root of the tokens, and lanes with the tokens a row. Only sums per block of
    the tables come to the driver: at most 2^MOST_BITS rows.
    """
    spark = docs.sparkSession
    counted = store(count_tokens(docs), "lm-counts")
    counts = counted.filter("kind = 0").groupBy("word").agg(F.sum("n").alias("n"), F.min("tail").alias("tail"))
    counts = store(counts, "lm-words")
    total, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    total = total or 0
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).toPandas()
    word, n, tail = top["word"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64), top["tail"].to_numpy(np.int64)
    ends = counted.filter("kind = 1").groupBy("tail", "word").agg(F.sum("n").alias("n")).toPandas()
    classes = Classes(np.sort(word[:SINGLE]), group_endings(*(ends[c].to_numpy(np.int64) for c in ("tail", "word", "n"))))

    grouped = F.arrow_udf(_class_and_part(classes), "int")("word", "tail")
    sums = counts.groupBy(grouped.alias("at")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).toPandas()  # a row per class and part
    mass, kinds = (np.bincount(sums["at"], sums[c].to_numpy(float), classes.number * PARTS).reshape(classes.number, PARTS) for c in ("n", "v"))
    inside = np.log10(mass + ADD * (kinds + 1))
    inside[:SINGLE] = 0

    bits = bits_for(total)
    weights = [np.zeros((outcomes, (1 << bits) + 1), np.float32) for outcomes in (classes.number, PARTS)]
    share = mass.sum(axis=1) + ADD
    weights[0][:, -1] = np.log(share / share.sum())
    # the part table starts at the class's own shares, by the feature that is the class alone
    alone = mix(np.arange(SINGLE, classes.number, dtype=np.uint64) + np.uint64(1 << 43)) >> np.uint64(64 - bits)
    spread = mass[SINGLE:] + ADD
    weights[1][:, alone.astype(np.int64)] = np.log(spread / spread.mean(axis=1, keepdims=True)).T
    lanes = max(1, int(total / rounds) // (LANE_TOKENS << bits))
    for r in range(rounds if total else 0):
        trained = _train_round(_lanes(docs, r, rounds, lanes), classes, weights, bits).withColumn("order", F.col("lane"))
        if lanes > 64:
            trained = _summed(trained.withColumn("lane", F.pmod("lane", F.lit(64))), ["table", "block", "lane"]).withColumn("order", F.col("lane"))
        for row in _summed(trained.withColumn("lane", F.lit(0).cast("bigint")), ["table", "block", "lane"]).toLocalIterator():
            own = weights[row["table"]]
            body = np.frombuffer(row["body"], np.float32).reshape(len(own) + 1, -1)
            seen = body[-1] > 0
            at = row["block"] + np.flatnonzero(seen)
            own[:, at] = body[:-1, seen] / body[-1, seen]
    return Model(classes, bits, weights, int(total), int(distinct), inside, counts.select("word", "n"), (word, n))


def _class_and_part(classes: Classes):
    kind = vars(classes)

    def place(words: pa.Array, tails: pa.Array) -> pa.Array:
        hashes = words.to_numpy().view(np.uint64)
        return pa.array((Classes(**kind).of(hashes, tails.to_numpy().astype(np.int64)) * PARTS + part_of(hashes)).astype(np.int32))

    return place


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Add to (doc_id, held_out, text) the token numbers and both scores; the text is dropped.

    Batches of sparse features give the class part. The rest of a token's probability is its count's share
    in its class: counts of frequent words are at hand in every task, those of the others are joined by word.
    """
    word, n = model.frequent
    bits = model.bits
    shared = docs.sparkSession.sparkContext.broadcast((vars(model.classes), model.weights, model.inside, word, n))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, weights, inside, word, n = shared.value
        own = Classes(**kind)
        slots, logs = np.zeros(1 << _SLOTS, np.uint64), np.zeros(1 << _SLOTS)
        at = (word >> np.uint64(64 - _SLOTS)).astype(np.int64)[::-1]
        slots[at], logs[at] = word[::-1], np.log10(n[::-1] + ADD)  # of words that meet in a slot the most frequent stays
        for batch in batches:
            for i, hashes, cls, f, g, sizes in _each_batch(batch.column(2), own, bits):
                chosen = np.empty(len(hashes))
                part = part_of(hashes)
                for b in range(0, len(hashes), BATCH):
                    e = slice(b, b + BATCH)
                    p = probabilities(weights[0], f[:, e])
                    chosen[e] = np.log10(np.maximum(p[cls[e], np.arange(p.shape[1])], 1e-30))
                    inner = np.flatnonzero(cls[e] >= SINGLE)
                    if len(inner):
                        p = probabilities(weights[1], g[:, e][:, inner])
                        chosen[b + inner] += np.log10(np.maximum(p[part[e][inner], np.arange(p.shape[1])], 1e-30))
                slot = (hashes >> np.uint64(64 - _SLOTS)).astype(np.int64)
                known = (slots[slot] == hashes) & (logs[slot] != 0)
                log_n = np.where(known, logs[slot], 0)
                grouped = cls >= SINGLE
                doc = np.repeat(np.arange(len(sizes)), sizes)
                add = lambda x: np.bincount(doc, x, len(sizes))
                rare, bounds = [], np.cumsum(sizes) - sizes
                rest = np.flatnonzero(~known)
                cut = np.searchsorted(rest, np.append(bounds, len(hashes)))
                for k in range(len(sizes)):
                    w, times = np.unique(hashes[rest[cut[k] : cut[k + 1]]], return_counts=True)
                    rare.append((w.view(np.int64), times))
                ends = np.cumsum([0] + [len(w) for w, _ in rare]).astype(np.int32)
                pairs = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate([w for w, _ in rare])), pa.array(np.concatenate([t for _, t in rare]).astype(np.int64))], ["word", "times"]
                )
                columns = [
                    batch.column(0).slice(i, len(sizes)), batch.column(1).slice(i, len(sizes)), pa.array(sizes.astype(np.int64)), pa.array(add(known).astype(np.int64)),
                    pa.array(add(log_n)), pa.array(add(chosen + np.where(grouped, log_n - inside[cls, part], 0))), pa.ListArray.from_arrays(pa.array(ends), pairs),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "known", "counts", "class_score", "rare"])

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, known bigint, counts double, class_score double, rare array<struct<word: bigint, times: bigint>>"
    scanned = docs.select("doc_id", "held_out", "text").mapInArrow(scan, schema)
    rows = store(scanned.withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.times")
    found = rare.join(model.counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(ADD))).alias("rare_counts"),
    )
    whole = rows.drop("rare").join(found, "row", "left").fillna(0, ["rare_known", "rare_counts"])
    base = np.log10(model.train_tokens + ADD * (model.vocabulary + 1))
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.col("rare_known")).alias("n_known"),
        F.lit(model.train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("counts") + F.col("rare_counts") - F.col("n_tokens") * F.lit(float(base))).alias("base_score"),
        (F.col("class_score") + F.col("rare_counts")).alias("score"),
    )


def score_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """Score every whole text by a model of the texts that are not held out.

    Tokens are the words (runs of bytes other than 0x20 and 0x09-0x0D, A-Z lower-cased) and one end per text.
    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-0.1 unigrams) and score, both log10.

    The model: log P(token) = log P(class | hashed features of the tokens before) + log P(part | class, hashed features) + log P(token | part).
    Frequent words are classes of their own; the others are grouped by their endings and dealt to PARTS parts of their class, which n-grams and
    skips choose between. Within a part a word's share is its smoothed count, with room for one unknown word; so the probabilities of all
    tokens sum to one in every context.

    A null, empty or blank text is its end alone. A null doc_id is held out; repeated rows are scored each and count
    each. Words are told apart by a 64-bit hash. Without any training text all tokens are unknown.
    """
    own = F.col(id_col).cast("bigint")
    rows = docs.select(own.alias("doc_id"), held_out(own, folds).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return score(rows, fit(rows.filter(~F.col("held_out")).select("doc_id", "text")))
