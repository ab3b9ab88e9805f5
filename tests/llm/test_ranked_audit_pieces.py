"""Ranked search, filter audit and piece encoding against brute force and the model's own library."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from brute import TRICKY, frame
from pairloom.llm import audit, pieces, ranked
from pairloom.llm.common import BYTE_VALUE, PIECE, text_view
from pairloom.llm.queries import tokenizer_path
from pairloom.llm.runs import run_hashes

MODEL = tokenizer_path("piece_bpe_32k.model")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = ["a", "b", "t", "h", "e", " ", "  ", "\n", "\t", "\r", "▁", "é", "ß", "中", "😀", "\x00", "<0x0A>", "</s>", "23", "...", "////", "ing", "́", "한", "�", " " * 8, "ñ", "İ", "क़", "=" * 9]


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def odd_texts(n, seed=3):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_runs_of_long_rows_are_cut_outside_runs():
    text = ("ab1 " * 50 + "x" * 3000 + " ") * (3 * PIECE // 3000)
    data, offsets = text_view(pa.array([text, "", "ab1", None, "y" * (5 * PIECE)]))
    hashes, rows = run_hashes(data, offsets, 0, 5, ranked.TERM, BYTE_VALUE)
    assert np.bincount(rows, minlength=5).tolist() == [len(text.split()), 0, 1, 0, 1]
    assert len(set(hashes.tolist())) == 3


# ranked search


def ranked_brute(docs, items, k=10):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(1 for _, b in bags if b)
    n_terms = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    out = []
    for i, own in asked.items():
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in own if df[t]}
        scored = []
        for d, bag in bags:
            m = 10 + (90 * sum(bag.values()) * n_docs) // max(n_terms, 1)
            s = sum(w * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t, w in weight.items() if bag[t])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(i, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("limits", [{}, {"pass_terms": 3, "block_docs": 7}])
def test_ranked_search_equals_brute_force(spark, limits):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(40)] + ["Ünit", "ünit", "x1", "X1"]
    weights = [1 / (k + 1) for k in range(len(words))]
    docs = [(k, " ".join(rnd.choices(words, weights, k=rnd.randint(0, 30))) if k % 9 else None) for k in range(300)]
    docs += [(7, "w1 w1, W1"), (7, "w1 w1, W1"), (400, "w2 " * 5000), (None, "w39 x1"), (None, "w39 x1"), (401, "!!! ---"), *TRICKY]
    docs += [(1000 + k, "same w38 text") for k in range(25)]
    items = [(k, " ".join(rnd.choices(words, k=rnd.randint(1, 70)))) for k in range(12)]
    items += [(20, "w38"), (21, None), (22, ""), (23, "never seen"), (24, "w1"), (24, "w2"), (None, "w3 w39"), (25, "The quick, x1-X1"), (26, " ".join(f"w{i}" for i in range(150)))]
    table = spark.createDataFrame([(i, t) for i, t in items], "item_id bigint, text string")
    got = ranked.ranked_search(frame(spark, docs).repartition(3), table, **limits)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == ranked_brute(docs, items)


def test_ranked_search_of_empty_tables(spark):
    items = spark.createDataFrame([(1, "w1")], "item_id bigint, text string")
    assert ranked.ranked_search(frame(spark).limit(0), items).count() == 0
    assert ranked.ranked_search(frame(spark), items.limit(0)).count() == 0
    assert ranked.ranked_search(frame(spark, [(1, None), (2, "")]), items).count() == 0


def test_masks_below_the_kth_score_are_not_evaluated(monkeypatch):
    """One rare term beats any number of common ones, so documents without it are never scored."""
    rare, common = np.uint64(5), np.uint64(9)
    docs = 1000
    key = np.concatenate([np.arange(20), ranked.BLOCK_DOCS + np.arange(docs)])
    held = [(pa.array(range(docs), pa.int64()), np.full(docs, 10), key, np.ones(len(key), np.int32))]
    row = ranked._block(held, 2).to_pylist()[0]
    block = ranked.Block(row, np.array([9000, 1]), docs, 10 * docs)
    seen = []
    exact = block.scores
    monkeypatch.setattr(block, "scores", lambda rows, some: seen.append(len(some)) or exact(rows, some))
    best = block.search(np.array([0, 1]), 10, [])
    assert [d for _, _, d in best] == list(range(10)) and sum(seen) == 20
    assert rare < common


# filter audit


def audit_brute(docs, labels):
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}  # a document without an id has no label
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    failing = []
    for i, t, part in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        tests = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and t in first and first[t] < i,
        }
        failing.append((part or "", {f for f, bad in tests.items() if bad}, i in good, i in toxic))
    out = []
    for part in {p for p, *_ in failing}:
        own = [f for f in failing if f[0] == part]
        total = Counter()
        rows = []
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                removed = [x for x in own if f in x[1] and not x[1] & before]
                total[f] += len(removed)
                kept = sum(1 for x in own if not x[1] & (before | {f}))
                redundant = sum(1 for x in own if f in x[1] and x[1] & before)
                unique = sum(1 for x in own if x[1] == {f})
                rows.append((part, "".join(order), k + 1, kept, len(removed), redundant, unique, sum(x[2] for x in removed), sum(x[3] for x in removed), f))
        out += [(*r[:-1], total[r[-1]]) for r in rows]
    return sorted(out)


def test_audit_equals_brute_force(spark):
    rnd = random.Random(4)
    long = [" ".join(rnd.choice(["alpha", "Beta", "beta", "GAMMA", "x#", "ö"]) + str(rnd.randint(0, 400)) for _ in range(rnd.randint(150, 260))) for _ in range(25)]
    docs = [(k, rnd.choice([*long, None, "", "short", "short", "A B C", "one | two", "É" * 30]), rnd.choice(["en", "de", None, ""])) for k in range(150)]
    docs += [(i, t, "odd") for i, t in TRICKY] + [(None, "short", "en"), (3, "short", "en"), (3, "short", "en"), (900, " ".join(map(str, range(200))), "clean")]
    labels = [(k, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for k in range(0, 150, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    rows = [(i, t, p, 7, "x", "y", 1) for i, t, p in docs]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, row int, part string, filter string, good int")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = audit.filter_audit(table.repartition(4), marks)
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert got.columns == columns
    assert sorted(tuple(r) for r in got.collect()) == audit_brute(docs, labels)


def test_audit_without_labels_and_rows(spark):
    docs = spark.createDataFrame([(1, "a", None)], "doc_id bigint, text string, lang string")
    rows = audit.filter_audit(docs).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""} and all(r.good_lost == r.toxic_lost == 0 for r in rows)
    assert all(r.shapley == (120 if r.filter_order[r.step - 1] == "A" else 0) for r in rows)
    assert audit.filter_audit(docs.limit(0)).count() == 0


def test_audit_joins_by_id_without_nested_loops(spark):
    fails = spark.createDataFrame([], "filter string, row bigint, part string, good int, toxic int")
    plan = audit.prefix_counts(fails)._jdf.queryExecution().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


# pieces


def test_encoding_is_the_librarys(model, library):
    for text in [*odd_texts(4000), *(t or "" for _, t in TRICKY)]:
        ids, counts = model.encode([text])
        assert ids.tolist() == library.encode(text) and counts.tolist() == [len(ids)], text


def test_encoding_without_cuts_is_the_librarys(model, library, monkeypatch):
    monkeypatch.setattr(model, "joined", np.ones_like(model.joined))
    model._clear()
    for text in odd_texts(800, seed=8):
        assert model.encode([text])[0].tolist() == library.encode(text), text
    model._clear()


LONG = ["a" * 150_000, "ab" * 100_000, "=" * 90_001, "the" * 60_000 + " \n" * 40_000]


def test_a_full_memory_starts_anew(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "_CACHE_SEGMENTS", 50)
    monkeypatch.setattr(pieces, "_CACHE_PAIRS", 20)
    for k in range(0, 600, 30):
        texts = odd_texts(600, seed=12)[k : k + 30]
        ids, counts = model.encode(texts)
        assert np.split(ids, np.cumsum(counts)[:-1])[-1].tolist() == library.encode(texts[-1])
        assert ids.tolist() == [i for t in texts for i in library.encode(t)]


@pytest.mark.parametrize("text", LONG, ids=["a", "ab", "=", "the"])
def test_long_segments_go_block_by_block(model, library, text):
    assert model.encode([text])[0].tolist() == library.encode(text)


def test_merge_checks_and_dead_ends(model):
    """Every token merges back from its own characters, and the tokens of a text never merge over their borders."""
    for text in odd_texts(300, seed=2):
        tokens = model.tokens(text.replace(" ", pieces.SPACE))
        assert all(len(model.merge(t)) == 1 for t in tokens)
        assert all(model.merge(a + b, len(a)) for a, b in zip(tokens, tokens[1:]))


def test_decoding_is_the_librarys(model, library):
    rnd = random.Random(6)
    for _ in range(4000):
        ids = [rnd.randrange(32000) if rnd.random() < 0.5 else rnd.randrange(262) for _ in range(rnd.randint(0, 8))]
        assert model.decode(np.array(ids, np.int64), np.array([0, len(ids)]))[0].as_py() == library.decode(ids), ids


def test_piece_query_on_odd_rows(spark, library):
    rows = [*TRICKY, *((100 + k, t) for k, t in enumerate(odd_texts(200, seed=11)))]
    table = frame(spark, rows).withColumnRenamed("row", "ids").withColumnRenamed("node", "decoded")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in rows:
        ids = library.encode(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    got = pieces.digests(table.repartition(3), MODEL)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    assert pieces.digests(table.limit(0), MODEL).count() == 0
    kept = pieces.decode(pieces.encode(table, MODEL, out="tokens"), MODEL, ids_col="tokens", out="back")
    assert kept.columns == [*table.columns, "tokens", "back"]


def test_all_documents_encode_as_in_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r in pieces.encode(docs, MODEL).select("text", "ids").collect():
        assert r.ids == library.encode(r.text)


def test_audit_keeps_no_texts_beside_the_measures(spark):
    """Texts stream through the measures; an evaluation beside the rows would queue them in the executor."""
    df = spark.createDataFrame([(1, "A b" * 2000, "x"), (2, None, None), (None, "b b b", "x"), (1, "A b" * 2000, "x")], "doc_id BIGINT, text STRING, lang STRING")
    asked = df.select("doc_id", F.col("lang").alias("part"), F.lit(b"d").alias("digest"), "text").mapInArrow(audit._measured, audit._MEASURED)
    assert "text" not in asked.columns
    got = sorted((r.doc_id or 0, r.part or "", r.words, r.distinct_words, r.chars, r.uppers, r.symbols) for r in asked.collect())
    assert got == [(0, "x", 3, 1, 5, 0, 0), (1, "x", 2001, 3, 6000, 2000, 0), (1, "x", 2001, 3, 6000, 2000, 0), (2, "", 0, 0, 0, 0, 0)]
    stored, _ = audit.failing_ids(df, None, id_col="doc_id", text_col="text", part_col="lang")
    assert stored.count() == 4
    assert max(b.num_rows for b in audit._measured(iter([_rows(3000)]))) <= audit._ROWS


def _rows(n):
    return pa.RecordBatch.from_pydict({"doc_id": list(range(n)), "part": ["x"] * n, "digest": [b"d"] * n, "text": ["a b"] * n})
