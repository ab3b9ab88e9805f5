"""Repeated byte windows: a depth-limited radix sort of suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import fits_broadcast, lookup
from ..session import release, store
from .common import BYTE_VALUE, mix, row_runs, text_view, window_sums

WINDOW = 200
#: Bytes of the first digit (a gram), and of the steps of the second and the third.
GRAM = 50
STEP, FINE = 25, 5
_REACH = WINDOW - GRAM  # a window holds a gram at 0.._REACH bytes from its start
_CORE = WINDOW - STEP  # bytes that all windows of a step share
_PLACE = np.uint64((1 << 24) - 1)
#: Bytes of a long text, and places of a text, that are worked on at once.
_PART, _MARKS = 1 << 22, 1 << 12
#: Rows that share a digit of _CORE bytes and are compared in one task; groups of more go through further passes.
GROUP = 1 << 12
_ODD = np.uint64(0xD6E8FEB86659FD93)


def _slices(sums: np.ndarray, down: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return mix((sums[stop] - sums[start]) * down[start] + (stop - start).astype(np.uint64))


def anchors(data: np.ndarray, offsets: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes of rows i..j-1 that take part: hash of the gram, row, byte position, bytes up to WINDOW from there on, hash of all bytes that a window around it can have.

    Every window of WINDOW bytes takes the position of its smallest gram hash (the first of equals). Equal
    windows take it at the same place, so every repeated window holds a gram that is an anchor in all its copies.
    """
    lo, hi = int(offsets[i]), int(offsets[j])
    out: list[tuple[np.ndarray, ...]] = []
    for at in range(lo, max(hi - WINDOW + 1, lo), _PART):  # a longer row is worked on in overlapping parts
        end = min(at + _PART + WINDOW - 1, hi)
        n = end - at
        if n < WINDOW:
            continue
        left, right = max(lo, at - _REACH), min(hi, end + WINDOW)
        sums, down = window_sums(BYTE_VALUE[data[left:right]], right - left)
        first = np.arange(at - left, at - left + n - GRAM + 1)
        grams = mix((sums[first + GRAM] - sums[first]) * down[first])
        width = _REACH + 1
        padded = np.full(-(-len(grams) // width) * width, np.uint64(2**64 - 1))
        padded[: len(grams)] = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        block = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(block, axis=1).ravel()
        behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = n - WINDOW + 1
        low = np.minimum(behind[:starts], ahead[_REACH : _REACH + starts])
        inside = np.ones(starts, bool)
        for b in offsets[i + 1 : j] - at:  # windows that would cross into the next row
            inside[max(0, b - WINDOW + 1) : max(0, b)] = False
        place = np.unique(low[inside] & _PLACE).astype(np.int64)
        row = np.searchsorted(offsets[i : j + 1], place + at, "right") - 1
        before = np.minimum(place + at - offsets[row + i], _REACH)
        after = np.minimum(offsets[row + i + 1] - place - at, WINDOW)
        here = place + at - left
        around = mix(_slices(sums, down, here - before, here + after) ^ mix((before * 1024 + after).astype(np.uint64)))
        out.append((grams[place], row + i, place + at - offsets[row + i], after, around))
    if not out:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none, none.astype(np.uint64)
    return tuple(np.concatenate(c) for c in zip(*out))


def _keys(text: str | Column) -> tuple[Column, Column]:
    c = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(c).alias("t1"), F.xxhash64(F.lit(1), F.octet_length(c), c).alias("t2")


def _anchor_rows(texts: DataFrame) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_view(batch.column(2))
            for i, j in row_runs(offsets):
                gram, row, place, after, around = anchors(data, offsets, i, j)
                if len(gram):
                    take = pa.array(row)
                    columns = [batch.column(0).take(take), batch.column(1).take(take), pa.array(place), pa.array(after.astype(np.int32)), pa.array(gram.view(np.int64)), pa.array(around.view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["t1", "t2", "pos", "after", "h", "node"])

    return texts.select("t1", "t2", "text").mapInArrow(scan, "t1 bigint, t2 bigint, pos bigint, after int, h bigint, node bigint")


def _step_rows(bodies: DataFrame, whole: bool) -> DataFrame:
    """Second digit, read from the texts by position. For each step j, ``key`` is of the _CORE bytes that all windows with j*STEP to
    (j+1)*STEP bytes before the gram share; with ``whole`` also the bytes that they can have on its left and right."""
    back = np.arange(0, _REACH, STEP)

    def part(raw: bytes, data: np.ndarray, pos: np.ndarray, node: np.ndarray, size: int) -> pa.RecordBatch:
        lo, hi = max(0, int(pos[0]) - _REACH), min(size, int(pos[-1]) + WINDOW)
        sums, down = window_sums(BYTE_VALUE[data[lo:hi]], hi - lo)
        before, after = np.minimum(pos, _REACH)[:, None], np.minimum(size - pos, WINDOW)[:, None]
        some = np.maximum(back, WINDOW - after) <= np.minimum(back + STEP, before)
        mark, j = np.nonzero((before >= back) & (after >= _CORE - back) & some)
        core = pos[mark] - back[j]
        key = mix(_slices(sums, down, core - lo, core + _CORE - lo) ^ mix(j.astype(np.uint64)))
        if not whole:
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], ["key"])
        start = pos[mark] - np.minimum(before[mark, 0], back[j] + STEP)
        stop = pos[mark] + np.minimum(after[mark, 0], WINDOW - back[j])
        sides = [pa.array([raw[a:b] for a, b in zip(x.tolist(), y.tolist())], pa.binary()) for x, y in ((start, core), (core + _CORE, stop))]
        return pa.RecordBatch.from_arrays([pa.array(node[mark]), pa.array(j.astype(np.int32)), pa.array(key.view(np.int64)), *sides], ["node", "j", "key", "l", "r"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_view(batch.column(0))
            for k in range(batch.num_rows):
                own, places = data[offsets[k] : offsets[k + 1]], batch.column(1)[k].values
                pos, node = (places.field(f).to_numpy() for f in ("pos", "node"))
                order = np.argsort(pos, kind="stable")
                pos, node, raw = pos[order], node[order], own.tobytes()
                for piece in np.split(np.arange(len(pos)), np.flatnonzero(np.diff(pos // _PART)) + 1):
                    for b in range(0, len(piece), _MARKS):
                        at = piece[b : b + _MARKS]
                        yield part(raw, own, pos[at], node[at], len(own))

    schema = "node bigint, j int, key bigint, l binary, r binary" if whole else "key bigint"
    return bodies.select("text", "places").mapInArrow(scan, schema)


def _beside_sums(column: pa.Array, backwards: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash sums of the first 0..STEP bytes of each value, with ``backwards`` of the last, one row per number of bytes; and the values' lengths."""
    data, offsets = text_view(column)
    size = np.diff(offsets)
    sums, power = np.zeros((STEP + 1, len(size)), np.uint64), 1
    for x in range(STEP):
        at = offsets[1:] - 1 - x if backwards else offsets[:-1] + x
        has = size > x
        sums[x + 1] = sums[x]
        sums[x + 1, has] += BYTE_VALUE[data[at[has]]] * np.uint64(power)
        power = power * int(_ODD) % (1 << 64)
    return sums, size


def _compared(rows: pa.Table) -> pa.RecordBatch:
    """Whole groups of step rows -> per row with a window that another row of its group has, the least and the most bytes before the gram of such windows."""
    key, node, j, l, r = (rows.column(c).combine_chunks() for c in ("key", "node", "j", "l", "r"))
    group = mix(key.to_numpy().view(np.uint64))
    (left, n_left), (right, n_right) = _beside_sums(l, True), _beside_sums(r, False)
    low, high = np.full(len(group), STEP + 1), np.full(len(group), -1)
    for x in range(STEP + 1):  # x bytes on the left of the core, the others on its right
        has = np.flatnonzero((n_left >= x) & (n_right >= STEP - x))
        window = mix(left[x, has] ^ mix(right[STEP - x, has] + group[has]))
        order = np.argsort(window)
        same = window[order[1:]] == window[order[:-1]]
        twice = has[order[np.append(same, False) | np.append(False, same)]] if len(has) else has
        low[twice], high[twice] = np.minimum(low[twice], x), x
    found = np.flatnonzero(high >= 0)
    first = j.to_numpy()[found] * STEP
    out = [pa.array(node.to_numpy()[found]), pa.array((first + low[found]).astype(np.int32)), pa.array((first + high[found]).astype(np.int32))]
    return pa.RecordBatch.from_arrays(out, ["node", "low", "high"])


def _group_spans(steps: DataFrame) -> DataFrame:
    """(node, low, high) of step rows in groups of at most GROUP, which meet in one task each; a task holds a batch and a group."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows of the last key, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut or (held and held[0].column(0)[0] != batch.column(0)[0]):
                yield _compared(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield _compared(pa.Table.from_batches(held))

    rows = steps.select("key", "node", "j", "l", "r").repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(scan, "node bigint, low int, high int")


def _repeated(rows: DataFrame, key: str, name: str) -> DataFrame:
    """(key, n): the groups of more than one row; groups of one go before anything is written."""
    return store(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), name)


def _large_spans(steps: DataFrame) -> DataFrame:
    """(node, low, high) of step rows in groups of any size, which are only counted: cells, then digits of WINDOW - FINE bytes, then whole windows."""
    left, right = F.octet_length("l"), F.octet_length("r")
    steps = steps.withColumn("full", F.xxhash64("key", left, "l", "r"))
    cells = store(steps.groupBy("key", "full").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")), "suffix-cells")
    shared = store(cells.filter("n > 1").select("key", "full", "n"), "suffix-shared")
    settled = lookup(steps, shared, ["key", "full"], weight="n", spread=["node"], how="inner")
    # all windows that a row of a shared cell has
    settled = settled.select("node", (F.col("j") * STEP + F.greatest(F.lit(0), F.lit(STEP) - right)).alias("low"), (F.col("j") * STEP + F.least(F.lit(STEP), left)).alias("high"))
    settled = store(settled.groupBy("node").agg(F.min("low").alias("low"), F.max("high").alias("high")), "suffix-settled")
    several = _repeated(cells, "key", "suffix-several")
    ends = lookup(steps, several, ["key"], weight="n", spread=["node"], how="inner").join(cells.select("key", "full", "node"), ["key", "full", "node"])

    # third digit: a step's windows in turns of FINE bytes, told apart by what they all have beside the core
    turns = F.explode(F.sequence(F.lit(0), F.lit(STEP // FINE - 1))).alias("s")
    fine = ends.select("node", "j", "key", "l", "r", turns)
    low, high = F.greatest(F.col("s") * FINE, F.lit(STEP) - right), F.least((F.col("s") + 1) * FINE, left)
    fine = fine.withColumns({"low": low, "high": high}).filter(
        (left >= F.col("s") * FINE) & (right >= F.lit(STEP - FINE) - F.col("s") * FINE) & (F.col("low") <= F.col("high"))
    )
    fine = fine.withColumn("turn", _beside(F.col("s") * FINE, F.lit(STEP - FINE) - F.col("s") * FINE))
    fine = store(fine.drop("s"), "suffix-turns")
    release(cells, shared, several)
    turns = _repeated(fine, "turn", "suffix-turn-keys")
    left_over = lookup(fine, turns, ["turn"], weight="n", spread=["node"], how="inner")
    # last digit: whole windows
    each = left_over.select("node", "j", "key", "l", "r", F.explode(F.sequence("low", "high")).alias("x"))
    windows = each.select("node", (F.col("j") * STEP + F.col("x")).alias("low"), _beside(F.col("x"), F.lit(STEP) - F.col("x")).alias("key"))
    windows = store(windows, "suffix-windows")
    release(fine, turns)
    twice = windows.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("y"), F.count(F.lit(1)).alias("n")).filter("x <> y").select("key", "n")
    twice = store(twice, "suffix-twice")
    reach = lookup(windows, twice, ["key"], weight="n", spread=["node"], how="inner").groupBy("node").agg(F.min("low").alias("low"), F.max("low").alias("high"))
    reach = store(settled.unionByName(reach), "suffix-large")
    release(windows, twice, settled)
    return reach


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(t1, t2, spans): per distinct text the byte ranges (start, stop) that repeated windows cover.

    ``texts`` has t1, t2 and text, copies included. Windows of one text count against each other, too.

    Suffixes are told apart by the most significant digits first, and a group of one is dropped by every pass.
    First pass: the gram of GRAM bytes at each anchor; of all suffixes only those at anchors
    take part, which is enough to find every repeated window. What goes on is positions (text key, position). Positions with equal
    surroundings (all bytes that a window there can have) are one node; if there are several, all their windows are
    repeated, and one of them stands for all. Second pass: digits of _CORE bytes, read again from the texts of the positions
    left. Nodes that share a digit differ only in the STEP bytes on each side of it. Up to GROUP of them meet in one task, which finds
    their repeated windows. Larger groups are only counted, never gathered, so a passage that a third of all texts share is no task's alone: nodes that agree
    in all bytes of the windows of a step have these repeated, and one of them stands for the cell. Where different cells share
    a digit the third pass goes on, by WINDOW - FINE bytes, and the last by whole windows: groups of several there are
    exactly the repeated windows. Lookups by a frequent key are spread. Tables are deleted when what is made of them is written.
    """
    first = store(_anchor_rows(texts), "suffix-anchors")
    grams = _repeated(first, "h", "suffix-grams")
    kept = lookup(first, grams, ["h"], weight="n", spread=["t1", "pos"], how="inner")
    # copies of a text give the same places: a set per text
    marks = store(kept.groupBy("t1", "t2").agg(F.collect_set(F.struct("pos", "after", "node")).alias("places")), "suffix-marks")
    release(first, grams)

    places = marks.select("t1", "t2", F.explode("places").alias("p")).select("t1", "t2", "p.*")
    nodes = store(places.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("t1", "t2", "pos")).alias("one")), "suffix-nodes")
    ones = nodes.select("one.t1", "one.t2", F.struct("one.pos", "node").alias("p")).groupBy("t1", "t2").agg(F.collect_list("p").alias("places"))
    ones = store(ones, "suffix-ones")
    wanted = ones.select("t1", "t2")
    some = texts.select("t1", "t2", "text")
    some = some.join(F.broadcast(wanted), ["t1", "t2"], "left_semi") if fits_broadcast(wanted) else some
    bodies = store(some.dropDuplicates(["t1", "t2"]).join(ones, ["t1", "t2"]).select("text", "places"), "suffix-bodies")
    release(ones)

    cores = _repeated(_step_rows(bodies, False), "key", "suffix-cores")
    any_large = not cores.filter(F.col("n") > GROUP).isEmpty()
    steps = lookup(_step_rows(bodies, True), cores.withColumn("size", F.col("n")), ["key"], weight="n", spread=["node"], how="inner")
    steps = store(steps, "suffix-steps")
    release(bodies, cores)
    reach = _group_spans(steps.filter(F.col("size") <= GROUP))
    large = [_large_spans(steps.filter(F.col("size") > GROUP).drop("size"))] if any_large else []
    for more in large:
        reach = reach.unionByName(more)
    # nodes in several places, and those with windows that another node has
    nothing = F.lit(None).cast("int")
    many = nodes.filter("copies > 1").select("node", "copies", nothing.alias("low"), nothing.alias("high"))
    known = many.unionByName(reach.withColumn("copies", F.lit(1).cast("bigint"))).groupBy("node")
    known = store(known.agg(F.max("copies").alias("copies"), F.min("low").alias("low"), F.max("high").alias("high")), "suffix-reach")
    release(steps, nodes, *large)
    found = lookup(places, known.withColumn("n", F.col("copies")), ["node"], weight="n", spread=["t1", "pos"], how="inner")
    before = F.least(F.col("pos"), F.lit(_REACH))
    low = F.when(F.col("copies") > 1, F.greatest(F.lit(0), F.lit(WINDOW) - F.col("after"))).otherwise(F.col("low"))
    high = F.when(F.col("copies") > 1, before).otherwise(F.col("high"))
    spans = found.select("t1", "t2", "pos", low.alias("low"), high.alias("high")).filter("low <= high")
    span = F.struct((F.col("pos") - F.col("high")).alias("start"), (F.col("pos") - F.col("low") + WINDOW).alias("stop"))
    return spans.groupBy("t1", "t2").agg(F.array_sort(F.collect_set(span)).alias("spans"))


def _beside(left: Column, right: Column) -> Column:
    """The key of a core together with the last ``left`` bytes before and the first ``right`` bytes behind it."""
    return F.xxhash64("key", left.cast("int"), F.substring("l", F.octet_length("l") - left + 1, left), F.substring("r", F.lit(1), right))


def _cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """What is left of each text: bytes removed, runs removed, and the SHA-256 of the rest."""
    data, offsets = text_view(texts)
    bounds = spans.offsets.to_numpy()
    starts, stops = (spans.values.field(f).to_numpy() for f in ("start", "stop"))
    removed, runs, digest = [], [], []
    for k in range(len(texts)):
        raw = memoryview(data[offsets[k] : offsets[k + 1]])
        start, stop = starts[bounds[k] : bounds[k + 1]], np.maximum.accumulate(stops[bounds[k] : bounds[k + 1]])
        opens = np.flatnonzero(np.append(True, start[1:] > stop[:-1])) if len(start) else np.zeros(0, np.int64)
        closes = np.append(opens[1:], len(start)) - 1 if len(start) else opens
        kept, at = hashlib.sha256(), 0
        for x, y in zip(start[opens].tolist(), stop[closes].tolist()):
            kept.update(raw[at:x])
            at = y
        kept.update(raw[at:])
        removed.append(int((stop[closes] - start[opens]).sum()))
        runs.append(len(opens))
        digest.append(kept.hexdigest())
    return pa.StructArray.from_arrays([pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digest, pa.string())], ["n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Every byte that lies in a WINDOW-byte string which also starts anywhere else in the corpus (in
    the same text, too; overlaps count) is removed; n_spans counts the maximal removed runs and kept_sha256
    is of the remaining bytes. Matches do not cross texts.

    A null text is empty. A text that occurs in several rows is removed whole if it has WINDOW bytes, and
    untouched otherwise; it still counts against all other texts. Two hashes of a text
    (128 bits) tell texts apart; doc_id is only carried along and may be null or repeated.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), *_keys(text))
    spans = repeated_spans(rows.filter(F.octet_length("text") >= WINDOW))
    copies = rows.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("t1", "t2", F.lit(True).alias("copied"))
    fate = store(spans.join(copies, ["t1", "t2"], "full"), "suffix-fate")
    fate = fate.select("t1", "t2", "copied", F.when(F.col("copied"), None).otherwise(F.col("spans")).alias("spans"))
    side = F.broadcast(fate) if fits_broadcast(fate) else fate
    joined = rows.join(side, ["t1", "t2"], "left").withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    cut = F.arrow_udf(_cut, "struct<n_removed: bigint, n_spans: bigint, kept_sha256: string>")
    none = F.expr("CAST(array() AS array<struct<start: bigint, stop: bigint>>)")
    opened = joined.withColumn("cut", cut(F.when(F.col("spans").isNotNull(), F.col("text")), F.coalesce("spans", none)))
    gone = F.col("copied").isNotNull() & (F.col("n_bytes") >= WINDOW)
    changed = F.col("spans").isNotNull()
    return opened.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).when(changed, F.col("cut.n_removed")).otherwise(0).cast("bigint").alias("n_removed"),
        F.when(gone, 1).when(changed, F.col("cut.n_spans")).otherwise(0).cast("bigint").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).when(changed, F.col("cut.kept_sha256")).otherwise(F.sha2("text", 256)).alias("kept_sha256"),
    )
