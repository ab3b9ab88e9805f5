"""Language model, quality model, mixing and packing."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brute import TRICKY, frame, words
from pairloom.llm import gam, lm, mixing, packing

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")


def is_held_out(i, of):
    return i is None or zlib.crc32(str(i).encode()) % of == 0


def test_token_counts_and_base_scores(spark):
    rows = TRICKY + [(100 + k, f"word{k % 7} and word{k % 3} or other{k}") for k in range(60)]
    got = lm.score_documents(frame(spark, rows)).collect()
    tokens = [[*words(t), b"\n"] for _, t in rows]
    count = Counter(x for (i, _), own in zip(rows, tokens) if not is_held_out(i, 10) for x in own)
    total, kinds = sum(count.values()), len(count)
    want = [(i, is_held_out(i, 10), len(own), sum(x in count for x in own), total) for (i, _), own in zip(rows, tokens)]
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    base = sorted(sum(math.log10((count[x] + 0.1) / (total + 0.1 * (kinds + 1))) for x in own) for own in tokens)
    assert sorted(r.base_score for r in got) == pytest.approx(base)
    assert all(r.score < 0 for r in got)
    assert lm.score_documents(frame(spark, [])).count() == 0


def test_model_beats_the_base_on_held_out_texts(spark):
    got = lm.score_documents(spark.read.parquet(f"{SF}/documents.parquet")).filter("held_out").groupBy().sum("score", "base_score", "n_tokens").first()
    assert got["sum(score)"] > got["sum(base_score)"] + 0.1 * got["sum(n_tokens)"]


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(k, f"a{k % 5} b{k % 3} c. d{k % 11}") for k in range(80)], "doc_id bigint, text string")
    model = lm.fit(docs)
    n = {r["word"]: r["n"] for r in model.counts.collect()}
    tails = {r["word"]: r["tail"] for r in lm.count_tokens(docs).filter("kind = 0").collect()}
    hashes = np.array(sorted(n), np.int64).view(np.uint64)
    tail = np.array([tails[x] for x in hashes.view(np.int64).tolist()])
    cls, part = model.classes.of(hashes, tail), lm.part_of(hashes)
    before = [3, 9, 1]  # three words of the corpus as the context
    total = 0.0
    for c in range(model.classes.number):
        words_before, classes_before = hashes[before], cls[before]
        f, g = lm.features(np.append(words_before, hashes[0]), np.append(classes_before, c), np.arange(4), model.bits)
        of_class = lm.probabilities(model.weights[0], f[:, 3:])[c, 0]
        if c < lm.SINGLE:
            total += of_class
            continue
        of_part = lm.probabilities(model.weights[1], g[:, 3:])[:, 0]
        for k in range(lm.PARTS):
            counts = [n[x] for x in hashes.view(np.int64)[(cls == c) & (part == k)].tolist()]
            share = (sum(counts) + lm.ADD * (len(counts) + 1)) / 10 ** model.inside[c, k]  # of its words and one unknown
            total += of_class * of_part[k] * share
    assert total == pytest.approx(1.0, abs=1e-4)


def test_scores_do_not_depend_on_the_file_layout(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    one = {r.doc_id: r.score for r in lm.score_documents(docs.coalesce(1)).collect()}
    many = {r.doc_id: r.score for r in lm.score_documents(docs.orderBy(F.desc("doc_id")).repartition(7)).collect()}
    assert one.keys() == many.keys() and all(many[k] == pytest.approx(v, rel=1e-5) for k, v in one.items())


def test_words_before_choose_between_words_of_a_class(spark):
    """Every first word is followed by one of its own; all second words look alike, so only a factor inside their class can tell them apart."""
    rnd = random.Random(2)
    rows = [(k, " ".join(f"q{w}x z{w * 7919 % 100000}ing" for w in rnd.choices(range(60), k=200))) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = lm.score_documents(docs).filter("held_out").groupBy().sum("score", "base_score", "n_tokens").first()
    gain = (got["sum(score)"] - got["sum(base_score)"]) / got["sum(n_tokens)"]
    # of the 2 * log10(60) for each pair of words half could be gained; the class alone gives log10(2) for each token
    assert gain > 0.45


def test_tables_grow_with_the_corpus():
    assert [lm.bits_for(n) for n in (0, 10**4, 10**6, 10**8, 10**10, 10**14)] == [10, 10, 11, 14, 18, 18]


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = gam.quality(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").filter("held_out").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert (good.predicted == 1).mean() > 0.97 and (bad.predicted == 0).mean() > 0.6
    pairs = [(g > b) for g in good.score for b in bad.score]
    assert np.mean(pairs) > 0.95


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (12, None, 0), (99, 1, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    rows = gam.quality(frame(spark), labels).collect()
    assert len(rows) == len(TRICKY) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert {r.score for r in rows if r.doc_id in (3, 4)} == {next(r.score for r in rows if r.doc_id == 3)}
    assert gam.quality(frame(spark), labels.limit(0)).filter("score <> 0.5").count() == 0
    assert gam.quality(frame(spark, []), labels).count() == 0
    kept = gam.keep_quality(frame(spark), labels)
    assert kept.columns == frame(spark, []).columns


def test_additive_model_learns_an_interaction():
    rnd = np.random.default_rng(0)
    x = rnd.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x, y, pair_rounds=120)
    assert ((model.score(x) > 0.5) == (y == 1)).mean() > 0.95


def test_exponent_meets_its_target(spark):
    sources = spark.createDataFrame([("a", 6000), ("b", 900), ("c", 100), ("d", 0)], "s string, tokens bigint")
    total = 7000
    a = mixing.exponent(sources, total, max_repeats=3.0)
    z = sum((t / total) ** a for t in (6000, 900, 100))
    assert (100 / total) ** a / z * total / 100 <= 3.0 + 1e-6
    less = a - 1 / mixing.GRID
    assert (100 / total) ** less / sum((t / total) ** less for t in (6000, 900, 100)) * total / 100 > 3.0
    e = mixing.exponent(sources, total, entropy=0.9)
    w = np.array([(t / total) ** e for t in (6000, 900, 100)])
    w /= w.sum()
    assert -(w * np.log(w)).sum() == pytest.approx(0.9, abs=1e-4)
    assert mixing.exponent(sources, 10 * total, max_repeats=2.0) == 1.0
    with pytest.raises(ValueError):
        mixing.exponent(sources, total)


def test_mixture_spends_its_budget(spark):
    rnd = random.Random(1)
    rows = [(k, " ".join(["w"] * rnd.randrange(1, 60)), "hot" if k % 3 else f"s{k % 5}") for k in range(900)] + [(None, "x y", None), (5000, None, "hot"), (5001, "", "void")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("pass_no", mixing.F.lit("clash"))
    out = mixing.mix_sources(docs, block_rows=16).toPandas()
    tokens = {i: len((t or "").split()) for i, t, _ in rows}
    total = defaultdict(int)
    for i, t, s in rows:
        total[s] += tokens[i]
    most = max(tokens.values())
    spent = out.groupby("source", dropna=False).n_tokens.sum()
    assert sum(total.values()) - most * len(total) <= spent.sum() <= sum(total.values()) + len(total)
    for s, n in spent.items():
        assert n <= 2.0 * total[None if s != s or s is None else s] + 1
    for (s, i), own in out.groupby(["source", "doc_id"]):
        assert sorted(own.pass_no) == list(range(len(own)))
    passes = out[out.source == "s0"].groupby("pass_no").order_key.nunique()
    assert (passes == out[out.source == "s0"].groupby("pass_no").size()).all()
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_encoder_agrees_with_the_tokenizer():
    tokenizer = Tokenizer.from_file(WORDS)
    odd = ["Hello, World!", "don't we'll I'M", "naïve Straße ΑΣ İstanbul", "á b c d \x1c e", "x <|endoftext|> y<|startoftext|>", "3.14 1,000 #$% ...", "क़ख़", "", " ", "ﬁ Ⅷ ² ½", "word." * 5, "日本語 テキスト"]
    texts = odd + [t or "" for _, t in TRICKY]
    ids, _, _ = packing.WordEncoder(WORDS).encode([t.encode() for t in texts])
    want = [x for t in texts for x in [*tokenizer.encode(t, add_special_tokens=False).ids, 1]]
    assert ids.tolist() == want


def test_ids_before_closing_marks_for_all_characters():
    """Characters that come apart or combine under the normal form do not change the ids around them."""
    tokenizer, encoder = Tokenizer.from_file(WORDS), packing.WordEncoder(WORDS)
    for chars in (range(0x21, 0x3000), range(0xF900, 0x10000)):
        words = [a + chr(c) + m for c in chars for a, m in (("", "."), ("", ",;"), ("e", "!?"), ("হ", ":"))]
        want = [x for g in tokenizer.encode_batch(words, add_special_tokens=False) for x in [*g.ids, 1]]
        assert encoder.encode([w.encode() for w in words])[0].tolist() == want


def cost(ends, total, at, price, length, inside):
    value, last = 0, 0
    where = dict(zip(at, price))
    for e in ends:
        n = e - last
        assert 0 < n <= length
        value += 0 if n & (n - 1) == 0 else length - n
        value += 0 if e == total else where.get(e, inside)
        last = e
    assert last == total
    return value


def test_cuts_are_the_cheapest():
    rnd = random.Random(7)
    for _ in range(40):
        total, length, inside = rnd.randrange(1, 60), 8, 5
        at = sorted({*rnd.sample(range(1, total + 1), min(total, rnd.randrange(1, 30))), total})
        price = [rnd.choice([0, 2]) for _ in at]
        got = packing.cut_points(total, np.array(at), np.array(price), length, inside)
        spots = sorted({0, *at, total, *range(max(0, total - length), total), *(m + k for m, n in zip([0, *at], at) if n - m > 2 for k in range(0, n - m, 2))})
        best = {0: 0}
        where = dict(zip(at, price))
        for j in spots[1:]:
            best[j] = min(best[i] + (0 if (j - i) & (j - i - 1) == 0 else length - (j - i)) for i in spots if i < j and j - i <= length and i in best) + (0 if j == total else where.get(j, inside))
        large = cost(got.tolist(), total, at, price, length, inside)
        assert large == best[total]


def test_pack_round_trip(spark):
    rows = TRICKY + [(200 + k, "Some words here. And more of them! " * (k % 40)) for k in range(150)]
    got = packing.pack(frame(spark, rows).repartition(3), WORDS).toPandas()
    tokenizer = Tokenizer.from_file(WORDS)
    want = Counter()
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want[i, len(ids)] += 1
    by_sequence = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert all((s.offset.to_numpy() == np.cumsum([0, *s.length[:-1]])).all() and s.length.sum() <= 2048 for _, s in by_sequence)
    assert got.groupby(got.doc_id.fillna(-1)).length.sum().sum() == sum(n * c for (_, n), c in want.items())
    single = {i: t for i, t in rows if i != 14}
    for i, own in got[got.doc_id.notna() & (got.doc_id != 14)].groupby("doc_id"):
        ids = np.array([*tokenizer.encode(single[int(i)] or "", add_special_tokens=False).ids, 1], "<u4")
        own = own.sort_values("start")
        assert own.start.tolist() == np.cumsum([0, *own.length[:-1]]).tolist() and own.doc_tokens.unique().tolist() == [len(ids)]
        assert own.ids_crc32.tolist() == [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(own.start, own.length)]
    sizes = got.groupby("sequence_id").length.sum()
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes)
    assert padding < 0.03 * got.length.sum()
    assert packing.pack(frame(spark, []), WORDS).count() == 0
