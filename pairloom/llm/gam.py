"""Quality score of texts: a generalised additive model with pairwise interactions."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import fits_broadcast
from ..session import store
from .common import mix, row_runs, text_view, word_hashes

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digit", "stop_mark", "loud_mark", "symbol", "multibyte",
    "line_ends", "distinct", "top_word", "distinct_pairs", "capital_runs",
)
#: Labelled rows used for learning, taken in the order of a hash of doc_id; the stated bound of the fit.
SAMPLE_ROWS = 40_000
BAGS = 6

_KIND = np.full(256, 7, np.int64)  # 7: other symbols
_KIND[128:192] = 8  # further bytes of a character
_KIND[192:] = 6  # first byte of a longer character
for _chars, _kind in (
    ("abcdefghijklmnopqrstuvwxyz", 0), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), ("0123456789", 2), (" \t", 3), ("\n\r", 4), (".,;:'\"-()", 5), ("!?", 9),
):
    _KIND[[ord(c) for c in _chars]] = _kind
_KINDS = 10


def features(column: pa.Array) -> np.ndarray:
    """One row of FEATURES for each whole text; null counts as empty."""
    data, offsets = text_view(column)
    out = np.zeros((len(column), len(FEATURES)))
    for i, j in row_runs(offsets):
        piece, sizes = data[offsets[i] : offsets[j]], np.diff(offsets[i : j + 1])
        kind = _KIND[piece]
        row = np.repeat(np.arange(j - i), sizes)
        n = np.bincount(row * _KINDS + kind, minlength=(j - i) * _KINDS).reshape(j - i, _KINDS).astype(float)
        runs = np.bincount(row[1:][(kind[1:] == 1) & (kind[:-1] == 1)], minlength=j - i) if len(row) > 1 else np.zeros(j - i)
        words, counts = word_hashes(data, offsets, i, j)
        chars = np.maximum(sizes - n[:, 8], 1)
        some = np.maximum(counts, 1)
        block = np.zeros((j - i, len(FEATURES)))
        block[:, 0], block[:, 1] = np.log1p(sizes), np.log1p(counts)
        block[:, 2] = (sizes - n[:, 3] - n[:, 4]) / some
        block[:, 3] = n[:, 1] / np.maximum(n[:, 0] + n[:, 1] + n[:, 6], 1)
        for at, k in ((4, 2), (5, 5), (6, 9), (7, 7), (8, 6)):
            block[:, at] = n[:, k] / chars
        block[:, 9] = n[:, 4] / some
        block[:, 13] = runs / chars
        at = 0
        for k, c in enumerate(counts.tolist()):
            own = words[at : at + c]
            at += c
            if c:
                _, times = np.unique(own, return_counts=True)
                block[k, 10], block[k, 11] = len(times) / c, times.max() / c
                block[k, 12] = len(np.unique(mix(own[1:] * np.uint64(3) + own[:-1]))) / max(c - 1, 1)
        out[i:j] = block
    return out


@dataclass
class Additive:
    """Lookup tables over bins: one per feature, one per pair of features."""

    edges: list[np.ndarray]
    intercept: float
    single: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    table: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1: additions of looked-up values, over the whole batch at once."""
        b = self.bins(np.nan_to_num(x))
        z = np.full(len(x), self.intercept)
        for f, values in enumerate(self.single):
            z += values[b[:, f]]
        for (f, g), values in zip(self.pairs, self.table):
            z += values[self.coarse[f][b[:, f]], self.coarse[g][b[:, g]]]
        return 1 / (1 + np.exp(-z))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Step per bin of a tree with few leaves over ordered bins; g, h: sums of gradients and curvatures."""
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    cuts = [0, len(g)]
    value = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + ridge)
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - a > 1:
                k = np.arange(a + 1, b)
                gain = value(a, k) + value(k, b) - value(a, b)
                top = int(np.argmax(gain))
                if gain[top] > best[0]:
                    best = (gain[top], int(k[top]))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(cuts[:-1], cuts[1:]):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + ridge)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The best crossing of one cut per side: its gain and the step in each cell."""
    corner = lambda m: np.pad(m.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    cg, ch = corner(g), corner(h)
    a, b = np.meshgrid(np.arange(1, g.shape[0]), np.arange(1, g.shape[1]), indexing="ij")
    gain, steps = 0, []
    for x0, x1, y0, y1 in ((0, a, 0, b), (0, a, b, -1), (a, -1, 0, b), (a, -1, b, -1)):
        s = [c[x1, y1] - c[x0, y1] - c[x1, y0] + c[x0, y0] for c in (cg, ch)]
        gain = gain + s[0] ** 2 / (s[1] + ridge)
        steps.append(s[0] / (s[1] + ridge))
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.empty(g.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = (s[i, j] for s in steps)
    return float(gain[i, j]), out


def bin_edges(x: np.ndarray, bins: int = 48) -> list[np.ndarray]:
    """Quantiles of every feature, as many as there are different ones."""
    quantile = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(x[:, f], quantile)) if len(x) else np.zeros(0) for f in range(x.shape[1])]


def averaged(models: list[Additive]) -> Additive:
    """One model whose tables are the means of those of ``models``, which have the same edges; a pair that a model lacks counts as zero."""
    first = models[0]
    single = [np.mean([m.single[f] for m in models], axis=0) for f in range(len(first.single))]
    table: dict[tuple[int, int], np.ndarray] = {}
    for m in models:
        for pair, values in zip(m.pairs, m.table):
            table[pair] = table.get(pair, 0) + values / len(models)
    pairs = sorted(table)
    return Additive(first.edges, float(np.mean([m.intercept for m in models])), single, first.coarse, pairs, [table[p] for p in pairs])


def fit(
    x: np.ndarray, y: np.ndarray, *, edges: list[np.ndarray] | None = None, coarse: int = 12, rounds: int = 160, pair_rounds: int = 60, n_pairs: int = 6, rate: float = 0.08, leaves: int = 3, ridge: float = 2.0
) -> Additive:
    """Cyclic boosting: in each round every feature in turn gets one shallow tree on the current
    residuals, added to its table; then the pairs that explain most of what is left do the same."""
    y = y.astype(float)
    rest = (y.sum() + 0.5) / (len(y) + 1)
    edges = bin_edges(x) if edges is None else edges
    single = [np.zeros(len(e) + 1) for e in edges]
    coarser = [np.arange(len(e) + 1) * coarse // (len(e) + 1) for e in edges]
    model = Additive(edges, float(np.log(rest / (1 - rest))), single, coarser)
    if len(y) == 0 or y.min() == y.max():
        return model
    b, z = model.bins(x), np.full(len(y), model.intercept)
    for _ in range(rounds):
        for f, values in enumerate(single):
            p = 1 / (1 + np.exp(-z))
            step = rate * _tree(*(np.bincount(b[:, f], w, len(values)) for w in (y - p, p * (1 - p))), leaves, ridge)
            values += step
            z += step[b[:, f]]
    cells = [coarser[f][b[:, f]] for f in range(x.shape[1])]
    square = lambda f, g, w: np.bincount(cells[f] * coarse + cells[g], w, coarse * coarse).reshape(coarse, coarse)
    p = 1 / (1 + np.exp(-z))
    gains = {(f, g): _quadrants(square(f, g, y - p), square(f, g, p * (1 - p)), ridge)[0] for f in range(x.shape[1]) for g in range(f)}
    model.pairs = sorted(gains, key=lambda k: (-gains[k], k))[:n_pairs]
    model.table = [np.zeros((coarse, coarse)) for _ in model.pairs]
    for _ in range(pair_rounds):
        for (f, g), values in zip(model.pairs, model.table):
            p = 1 / (1 + np.exp(-z))
            step = rate * _quadrants(square(f, g, y - p), square(f, g, p * (1 - p)), ridge)[1]
            values += step
            z += step[cells[f], cells[g]]
    return model


def held_out(id_col: str | Column, of: int) -> Column:
    """True where crc32 of doc_id as text is divisible by ``of``; a null doc_id is held out."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % of == 0, F.lit(True))


def _flat(x: pa.ListArray) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def features_of(text: str | Column) -> Column:
    """The features of a whole text as an array column."""

    def scan(texts: pa.Array) -> pa.Array:
        x = features(texts)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32)), pa.array(x.ravel()))

    return F.arrow_udf(scan, "array<double>")(text)


def train(known: DataFrame, *, sample_rows: int = SAMPLE_ROWS, bags: int = BAGS) -> Additive:
    """Fit on (doc_id, x, label): at most ``sample_rows`` rows, in the order of a hash of doc_id.

    Each bag is a task that leaves out its own tenth of the sample; all bags have the same bins, and their tables are averaged to one model.
    """
    spark = known.sparkSession
    drawn = known.filter("label is not null").orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows)
    rows = drawn.select("x", F.col("label").cast("double").alias("label")).toPandas()
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    x = np.nan_to_num(x)
    shared = spark.sparkContext.broadcast((x, rows["label"].to_numpy(), bin_edges(x)))

    def bag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x, y, edges = shared.value
        for batch in batches:
            for k in batch["id"]:
                keep = np.arange(len(y)) % 10 != k if len(y) >= 100 else np.ones(len(y), bool)
                yield pd.DataFrame({"bag": [k], "model": [pickle.dumps(vars(fit(x[keep], y[keep], edges=edges)))]})

    fitted = spark.range(0, bags, 1, bags).mapInPandas(bag, "bag bigint, model binary").orderBy("bag").collect()
    return averaged([Additive(**pickle.loads(bytes(r["model"]))) for r in fitted])


def score_of(spark: SparkSession, column: str | Column, model: Additive, *, of_text: bool) -> Column:
    """The model's score for a text column, or for a column of its features."""
    shared = spark.sparkContext.broadcast(vars(model))

    def scan(values: pa.Array) -> pa.Array:
        x = features(values) if of_text else _flat(values)
        return pa.array(Additive(**shared.value).score(x) if len(x) else np.zeros(0), pa.float64())

    return F.arrow_udf(scan, "double")(column)


def _marks(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").alias("label")).filter("label is not null")


def quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted.

    Only labels of rows that are not held out are learned from; only the text is an input.
    Null, empty and blank texts get the score of an empty text. A null doc_id is held out.
    Labels of unknown documents and null labels count for nothing; repeated rows and labels
    each count. Without labels, or with labels of one kind, the score is that of their share.
    """
    own = F.col(id_col).cast("bigint")
    rows = store(docs.select(own.alias("doc_id"), held_out(own, folds).alias("held_out"), features_of(text_col).alias("x")), "features")
    model = train(rows.filter(~F.col("held_out")).join(_marks(labels), "doc_id"))
    out = rows.select("doc_id", "held_out", score_of(docs.sparkSession, "x", model, of_text=False).alias("score"))
    return out.select("*", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores at least ``threshold``.

    Learns as ``quality`` does: from labels of rows that are not held out. The texts of labelled rows
    are read for the fit, all texts once more for the scores; labels measured to be few go to the texts.
    """
    own = F.col(id_col).cast("bigint")
    texts = docs.select(own.alias("doc_id"), F.col(text_col).alias("text")).filter(~held_out("doc_id", folds))
    marks = _marks(labels)
    side = F.broadcast(marks) if fits_broadcast(marks) else marks
    marked = texts.join(side, "doc_id").select("doc_id", "label", features_of("text").alias("x"))
    model = train(store(marked, "labelled"))
    return docs.filter(score_of(docs.sparkSession, text_col, model, of_text=True) >= threshold)
