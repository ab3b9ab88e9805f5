"""Near-duplicates, lines, repeated windows and fingerprints against brute force."""

import hashlib
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brute import TRICKY, frame, joined, shingles, similar, without_repeats, words
from pairloom.llm import bloom, common, fingerprint, graph, lines, minhash, suffix
from pairloom.llm.common import text_view
from pairloom.operators import joins
from pairloom.session import shared_dir, store

SF = "/root/testdata/sf0.001"


def test_word_hashes_follow_the_words():
    texts = [t for _, t in TRICKY] + ["a" * 3_000_000 + " b", "w " * 900_000]
    got = [len(s) for s in common.text_shingles(pa.array(texts, pa.string()), 5)]
    assert got == [len(shingles(t)) for t in texts]


def test_components(spark):
    rnd = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(50)] + [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    want = joined(300, links)
    assert got == {x: want[x] for a, b in links if a != b for x in (a, b)}
    assert graph.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def near_expected(rows):
    sets = [shingles(t) for _, t in rows]
    root = joined(len(rows), similar(sets, lambda both, union: 100 * both >= 85 * union))
    low = {}
    for (i, _), r in zip(rows, root):
        low[r] = min(low.get(r, 10**9), 10**9 if i is None else i)
    shown = [None if low[r] == 10**9 else low[r] for r in root]
    return sorted(((i, len(s), c, i == c) for (i, _), s, c in zip(rows, sets, shown)), key=str)


def test_near_duplicates(spark):
    near = [(100 + k, " ".join(f"n{i}" if i % 97 != k else "edit" for i in range(200))) for k in range(60)]
    rows = TRICKY + near
    got = minhash.near_duplicates(frame(spark, rows)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == near_expected(rows)
    assert minhash.near_duplicates(frame(spark, [])).count() == 0


def test_long_keys_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(graph, "FEW", 2)
    monkeypatch.setattr(graph, "BLOCK", 8)
    rnd = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for k in range(60):
        own = base.copy()
        for _ in range(rnd.choice([0, 1, 2, 3, 8])):
            own[rnd.randrange(120)] = f"e{rnd.randrange(40)}"
        rows.append((k, " ".join(own)))
    got = minhash.near_duplicates(frame(spark, rows)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == near_expected(rows)


def test_one_of_each_near_group_stays(spark):
    docs = frame(spark)
    kept = minhash.keep_one(docs, similarity=80)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 3, 4, 5, 6, 8, None, 9, 10, 11, 12, 14, 15, 16], key=str)


def char_shingles(line, k=8):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)
    return {low[i : i + k] for i in range(max(1, len(low) - k + 1))}


def test_pairs_of_lines_are_compared_as_sets_all_at_once(monkeypatch):
    rng = np.random.default_rng(5)
    words = ["alpha", "beta ", "Gamma", "dé", "日本 ", "z" * 40, "x", " "]
    left = ["".join(rng.choice(words, rng.integers(1, 60))) for _ in range(300)] + ["a", "A", "ab", "", "", "aaaaaaaaaaaa"]
    right = [x[: len(x) - rng.integers(0, 9)] + "end" * rng.integers(0, 2) or x for x in left[:300]] + ["a", "a", "ac", "", "x", "aaaaaaaa"]
    monkeypatch.setattr(lines, "_sets", None)  # one line after another
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(left))), pa.array(range(len(left))), pa.array(left), pa.array(right)], ["a", "b", "x", "y"])
    for part in (batch, batch.slice(300), batch.slice(7, 0)):
        got = [k for out in lines._jaccard(0.8, 8)(iter([part])) for k in out.column(0).to_pylist()]
        sets = [(k, char_shingles(left[k]) if left[k] else set(), char_shingles(right[k]) if right[k] else set()) for k in part.column(0).to_pylist()]
        assert got == [k for k, x, y in sets if len(x & y) >= 0.8 * len(x | y) - 1e-9]


def test_signatures_find_similar_lines():
    rnd = random.Random(5)
    found = total = 0
    for _ in range(300):
        a = [rnd.choice("abcdefghij ") for _ in range(rnd.randrange(60, 300))]
        b = a.copy()
        for _ in range(1 + len(a) // 150):
            b[rnd.randrange(len(b))] = "z"
        a, b = "".join(a), "".join(b)
        x, y = char_shingles(a), char_shingles(b)
        if len(x & y) >= 0.8 * len(x | y):
            total += 1
            p, q = lines.signatures(pa.array([a, b]), lines.SHINGLE, lines.BANDS, lines.ROWS)
            found += bool((p == q).any())
    assert total > 100 and found / total >= 0.97


def test_line_dedup(spark):
    long_line = "a sentence that is long enough to be compared by its shingles, number {} of the list, and it goes on for a while"
    rows = TRICKY + [(50 + k, f"{long_line.format(k)}\nown {k * 7919} words {k}") for k in range(12)]
    docs = frame(spark, rows)
    out = lines.dedup_lines(docs, counts=True)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"]
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    every = [(k, p, x) for k in order for p, x in enumerate((rows[k][1] or "").split("\n")) if x.strip()]
    first_of = {}
    every = [(k, p, x, first_of.setdefault((rows[k], p), (k, p))) for k, p, x in every]  # repeated rows are one document
    sets = [char_shingles(x) for _, _, x, _ in every]
    root = joined(len(every), similar(sets, lambda both, union: both >= 0.8 * union))
    keep = {(k, p) for n, (k, p, _, one) in enumerate(every) if one == every[root[n]][3]}
    want = []
    for k, (i, text) in enumerate(rows):
        split = (text or "").split("\n")
        left = [x for p, x in enumerate(split) if not x.strip() or (k, p) in keep]
        if text is None or left == split:
            want.append((i, text))
        elif any(x.strip() for x in left):
            want.append((i, "\n".join(left)))
    assert got == sorted(want, key=str)
    assert lines.dedup_lines(frame(spark, [])).count() == 0


def test_rows_that_repeat_a_document_go_together(spark):
    line = "some line that is kept by the first document"
    rows = [(1, line), (7, line), (7, line), (8, f"{line}\nand a line of its own\n"), (8, f"{line}\nand a line of its own\n"), (9, f"\n \n{line}\n"), (None, line)]
    got = lines.dedup_lines(frame(spark, rows), counts=True).collect()
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got) == [(1, line, 0, 0), (8, "and a line of its own\n", 2, 1), (8, "and a line of its own\n", 2, 1)]


def test_line_spans_are_those_of_a_split():
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("ab \n\t\r") for _ in range(rnd.randrange(0, 30))) for _ in range(400)] + ["", "\n", "a", "a\n", "\na", " "]
    data, offsets = text_view(pa.array(texts))
    starts, ends, row, number = lines._line_spans(data, offsets, 0, len(texts))
    got = [(r, k, bytes(data[a:b]).decode()) for a, b, r, k in zip(starts, ends, row.tolist(), number.tolist())]
    assert got == [(r, k, x) for r, t in enumerate(texts) for k, x in enumerate(t.split("\n")) if x.strip(" \t\r\x0b\x0c")]
    assert lines._gathered(data, starts, ends).to_pylist() == [x for _, _, x in got]


def test_repeated_windows(spark):
    rnd = random.Random(2)
    make = lambda n: "".join(rnd.choice("abcde ") for _ in range(n))
    shared, edge = make(260), make(199)
    more = [(20, make(90) + shared + make(40)), (21, shared + make(10)), (22, make(5) + shared[:230]), (23, edge + make(9)), (24, make(7) + edge)]
    more += [(30 + k, make(k) + shared[k : k + 220] + make(30)) for k in range(30)] + [(70, "z" * 200), (71, "y" * 201), (72, make(400))]
    rows = TRICKY + more
    got = suffix.remove_repeats(frame(spark, rows)).collect()
    want = without_repeats([(t or "").encode() for _, t in rows])
    assert sorted((tuple(r) for r in got), key=str) == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=str)
    assert suffix.remove_repeats(frame(spark, [])).count() == 0


def _passages(seed: int, n: int) -> list[tuple]:
    """Texts with cuts of a few passages, at all places, between words of their own."""
    rnd = random.Random(seed)
    make = lambda size: "".join(rnd.choice("abcde ") for _ in range(size))
    shared = [make(420) for _ in range(3)]
    rows = []
    for k in range(n):
        passage, at = rnd.choice(shared), rnd.randrange(0, 150)
        rows.append((k, make(rnd.randrange(0, 80)) + passage[at : at + rnd.randrange(190, 300)] + make(rnd.randrange(0, 80))))
    return rows


@pytest.mark.parametrize("group", [2, 7, None])
def test_repeated_windows_in_groups_of_any_size(spark, monkeypatch, group):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    if group:
        monkeypatch.setattr(suffix, "GROUP", group)
    rows = _passages(5, 60) + [(99, None), (None, "x" * 450)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # groups go on in the next batch
    try:
        got = suffix.remove_repeats(frame(spark, rows)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = without_repeats([(t or "").encode() for _, t in rows])
    assert sorted((tuple(r) for r in got), key=str) == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=str)


def test_repeated_windows_are_not_written_one_by_one(spark, monkeypatch):
    written, store = {}, suffix.store

    def counted(df, name, **options):
        out = store(df, name, **options)
        written[name] = out.count()
        return out

    monkeypatch.setattr(suffix, "store", counted)
    assert suffix.remove_repeats(frame(spark, _passages(6, 200))).count() == 200
    assert written["suffix-steps"] > 500
    assert max(written.values()) == max(written["suffix-steps"], written["suffix-anchors"])


def test_anchors_of_a_long_text_do_not_depend_on_the_cut():
    rnd = np.random.default_rng(1)
    text = rnd.integers(97, 123, (1 << 22) + 5000, dtype=np.uint8)
    whole = suffix.anchors(text, np.array([0, len(text)]), 0, 1)[2]
    tail = suffix.anchors(text[-20_000:], np.array([0, 20_000]), 0, 1)[2] + len(text) - 20_000
    assert set(tail.tolist()) <= set(whole.tolist()) and len(np.unique(whole)) >= len(text) // suffix.WINDOW


@pytest.mark.parametrize("rows", [TRICKY, [(1, "q w e r")], []])
def test_fingerprints(spark, rows):
    got = sorted((tuple(r) for r in fingerprint.fingerprint_edits(frame(spark, rows)).collect()), key=str)
    order = sorted(rows, key=lambda r: (-(2**63 - 1) if r[0] is not None and False else (0 if r[0] is not None else 1), -(r[0] or 0), r[1] or ""))
    want = []
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 3
        edited = t[: len(t) - cut] + following[:cut]
        x, e, y = fingerprint.fingerprints(pa.array([t, edited, following]))
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), fingerprint.written(x), fingerprint.written(e), fingerprint.likeness(x, e), fingerprint.likeness(x, y)))
    assert got == sorted(want, key=str)


def independent_prints(text):
    """A second version of the shingle rule, on words as bytes: equal sets must give equal fingerprints and the other way round."""
    return frozenset(shingles(text))


@pytest.mark.parametrize("n,miss,error", [(10, 0.05, 0.25), (20, 0.001, 0.15), (60, 0, 0.07), (300, 0, 0.03)])
def test_likeness_by_length_of_the_text(n, miss, error):
    """Texts wholly contained in one 30 times as long, and texts of which two thirds are: what the estimate gives against the true share."""
    rnd = random.Random(n)
    texts, shares = [], []
    for _ in range(300):
        own = [f"w{rnd.randrange(10**6)}" for _ in range(n)]
        other = [f"w{rnd.randrange(10**6)}" for _ in range(30 * n)]
        at = rnd.randrange(29 * n)
        part = own[: 2 * n // 3]
        texts += [" ".join(own), " ".join(other[:at] + own + other[at:]), " ".join(part + other)]
        x, y = independent_prints(texts[-3]), independent_prints(texts[-1])
        shares.append(len(x & y) / len(x))
    prints = list(fingerprint.fingerprints(pa.array(texts)))
    whole = [fingerprint.likeness(x, y) for x, y in zip(prints[0::3], prints[1::3])]
    assert all(v == (1.0 if len(x) else 0.0) for v, x in zip(whole, prints[0::3])) and sum(v == 0 for v in whole) <= miss * 300
    off = [abs(fingerprint.likeness(x, z) - s) for x, z, s in zip(prints[0::3], prints[2::3], shares) if len(x)]
    assert sum(off) / len(off) < error


def test_fingerprints_tell_sets_of_shingles_apart():
    rnd = random.Random(9)
    texts = [" ".join(rnd.choice("abcde") for _ in range(rnd.randrange(0, 14))) for _ in range(800)] + [t or "" for _, t in TRICKY]
    limit = 2**64 // fingerprint.ONE_IN
    prints = [p.tolist() for p in fingerprint.fingerprints(pa.array(texts))]
    sets = [independent_prints(t) for t in texts]
    hash_of = {}  # of texts with one shingle: its hash, if it is kept
    for s, p in zip(sets, prints):
        assert p == sorted(set(p)) and all(h < limit for h in p) and len(p) <= len(s)
        if len(s) == 1:
            assert hash_of.setdefault(s, p) == p
    for s, p in zip(sets, prints):  # a fingerprint is the union of those of its shingles
        known = [hash_of[frozenset([x])] for x in s if frozenset([x]) in hash_of]
        assert all(set(k) <= set(p) for k in known)
    both = {}
    for s, p in zip(sets, prints):
        assert both.setdefault(s, p) == p


def test_a_heavy_id_is_cut_into_several_buckets(spark):
    rows = [(7, f"text number {k} " * 12) for k in range(400)] + [(k, f"other {k} words here and there") for k in range(100, 200)] + [(None, None)] * 3
    got = fingerprint.fingerprint_edits(frame(spark, rows).repartition(5))
    assert got.count() == len(rows)
    spread = fingerprint._neighbours(frame(spark, rows), "doc_id", "text").filter("doc_id = 7 and guest = 0").groupBy("bucket").count().collect()
    assert len(spread) >= 4 and max(r["count"] for r in spread) < 200


def test_fingerprints_estimate_containment_and_merge():
    rnd = random.Random(4)
    big = " ".join(f"t{rnd.randrange(10**6)}" for _ in range(20_000))
    small = " ".join(big.split()[3000:4500])
    x, y, z = fingerprint.fingerprints(pa.array([big, small, small + " " + big]))
    assert fingerprint.likeness(x, y) == 1.0
    assert abs(len(x) / (len(words(big)) - 4) - 1 / fingerprint.ONE_IN) < 0.02
    assert set(fingerprint.merge(x, y).tolist()) <= set(z.tolist()) and len(z) - len(fingerprint.merge(x, y)) <= 5  # the seam's shingles
    assert np.array_equal(fingerprint.read(fingerprint.written(x)), x)


def test_line_dedup_in_rounds_leaves_only_its_result(spark, monkeypatch):
    rnd = random.Random(8)
    pool = [" ".join(f"w{rnd.randrange(900)}" for _ in range(9)) for _ in range(40)]
    rows = [(i, "\n".join(rnd.choice(pool) + rnd.choice(["", "", " x", "!"]) for _ in range(6)) + f"\nown line of {i} {rnd.random()}") for i in range(60)]
    docs = frame(spark, rows + [(None, None), (5, ""), (5, rows[5][1])])
    want = sorted(map(str, lines.dedup_lines(docs, counts=True).collect()))
    folder = Path(shared_dir(spark).removeprefix("file://"), "pairloom")
    there = set(folder.iterdir())
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(lines, "ROUND_KEYS", 1000)
    assert sorted(map(str, lines.dedup_lines(docs, counts=True).collect())) == want
    assert [p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - there] == ["removed-lines"]


def test_bit_field_misses_no_key(spark):
    keys = store(spark.range(0, 20000, 1, 5).select((F.col("id") * 7919 - 40_000_000).alias("k")), "field-keys")
    held = np.arange(20000) * 7919 - 40_000_000
    for most in (bloom.MOST, 1 << 16):  # at its full size, and as large as it may be
        field = bloom.bit_field(keys, "k", most=most).value
        assert bloom.may_hold(field, held).all()
    field = bloom.bit_field(keys, "k").value
    assert bloom.may_hold(field, held + 1).mean() < 0.05
    assert not bloom.may_hold(bloom.bit_field(store(keys.limit(0), "field-none"), "k").value, held).any()
