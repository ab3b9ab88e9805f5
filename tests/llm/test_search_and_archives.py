"""Top-k search, archives, registered queries and the pipeline."""

import gzip
import io
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from brute import TRICKY, frame
from compare import compare, connect
from pairloom.llm import mixing, queries, topk, warc
from pairloom.session import shared_dir

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) == ""


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
    assert {"pipeline", *queries.QUERIES} <= set(contract.queries())


def test_top_k_of_odd_vectors(spark):
    rnd = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rnd.normal(size=12)], 1) for k in range(300)]
    rows += [(300, None, 1), (301, [], 1), (302, [1.0, None], 1), (303, [float("nan")], 1), (304, [float("inf")], 1), (None, [1.0], 1), (100, [3.0] * 20, 2), (400, [0.0] * 12, 2)]
    rows += [(500 + k, [2.0] * 12, 1) for k in range(15)] + [(600, [1e9, -1e9], 1)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, row int")
    got = sorted(tuple(r) for r in topk.search_self(table).collect())
    sound = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for k, (i, q) in enumerate(sound):
        if i % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, (j, v) in enumerate(sound) if m != k)[:10]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert got == sorted(want)
    assert topk.search_self(table.limit(0)).count() == 0
    alone = topk.search_self(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<float>"))
    assert [tuple(r) for r in alone.collect()] == [(0, 1, 1, 1024 * 2048)]


def test_bounds_drop_only_what_cannot_win():
    rnd = np.random.default_rng(1)
    q, x = rnd.integers(-500, 500, (5, 32)), rnd.integers(-500, 500, (400, 32))
    exact = q @ x.T
    for k in topk.LEVELS:
        assert (topk._statistics(q, k) @ topk._statistics(x, k).T >= exact - 1e-6).all()


def test_archive_of_odd_pages(spark):
    rows = [(5, "u", "x"), (5, "u", "x"), (5, "v", "x"), (None, None, "x"), (3, "a\r\nb: c", None), (4, "", ""), (None, "q", "z"), (9, "u", "é" * 10), (10, "u", "WARC/1.1 " * 30_000)]
    pages = spark.createDataFrame([(*r, 1, "d") for r in rows], "page_id bigint, url string, html string, size int, digest string")
    got = sorted((tuple(r) for r in warc.round_trip(pages).collect()), key=str)
    lead = {"x": 5, "": 4, "z": None, "é" * 10: 9, "WARC/1.1 " * 30_000: 10}
    want, used = [], set()
    for i, u, h in sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), [-ord(c) for c in r[1] or ""])):
        payload = (h or "").encode()
        first = (h or "") not in used
        used.add(h or "")
        want.append((i, len(payload), warc.digest_of(payload), "response" if first else "revisit", None if first else lead[h or ""]))
    assert got == sorted(want, key=str)
    assert warc.round_trip(pages.limit(0)).count() == 0


@pytest.mark.parametrize("split", [1, 300, 5000, 1 << 30])
def test_every_record_is_read_once(split):
    members = [warc.record("response", k, "u", None, "D", k, (b"\x1f\x8b\x08" + bytes([k % 256])) * k) for k in range(60)]
    broken = gzip.compress(b"WARC/1.1\r\nbroken")[:-12]
    data = b"".join(members[:30]) + b"noise \x1f\x8b\x08 noise" + broken + b"".join(members[30:]) + gzip.compress(b"not a record")
    got = []
    for start in range(0, len(data), max(split, len(data) // 400)):
        end = min(start + max(split, len(data) // 400), len(data))
        got += [h["warc-record-id"] for _, h, _ in warc.records_in(io.BytesIO(data), start, end)]
    assert got == [f"<urn:page:{k}>" for k in range(60)]


def test_records_come_back_whole(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    files = warc.write_warc(pages).select("path", "size")
    back = warc.read_warc(files, split_bytes=4096).filter("record_type = 'response'")
    same = back.join(pages, warc.page_of("record_id") == F.col("page_id")).filter(F.col("payload").cast("string") == F.coalesce("html", F.lit("")))
    assert same.count() == back.count() > 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.store(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert 0 < counts[0] < 200 and counts[1] <= counts[0] and counts[2] <= counts[1]
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == kept


def test_pipeline_leaves_only_the_table_of_its_last_stage_but_one(spark):
    folder = Path(shared_dir(spark).removeprefix("file://"), "pairloom")
    there = set(folder.iterdir())
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert [p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - there] == ["mixture"]


def test_pipeline_on_odd_rows(spark, tmp_path):
    rows = [(i, t, "en", None if i == 4 else "s", len(t or "")) for i, t in TRICKY]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for part in (docs, docs.limit(0)):
        out = part
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, str(tmp_path))
        assert (out.count() > 0) == (part.count() > 0)


def test_sequences_follow_the_mixture(spark):
    """Sources lie one after the other in the input; packed, they come side by side, and a source's second pass after its first."""
    rows = [(i, f"word{i} " * 20, "en", "large" if i < 900 else "small", 100) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(1)
    mixed = corpus_pipeline.mixture(spark, docs, SF)
    placed = mixing.mix_sources(docs, place_col="at").collect()
    want = [r.doc_id for r in sorted(placed, key=lambda r: (r["at"], r.pass_no, r.order_key))]
    for source in ("large", "small"):
        own = [r for r in placed if r.source == source]
        assert sorted(own, key=lambda r: r["at"]) == sorted(own, key=lambda r: (r.pass_no, r.order_key))
        assert all(0 <= r["at"] <= 1 for r in own)
    written = corpus_pipeline.store(mixed, "test-order")
    pieces = corpus_pipeline.packed(spark, written, SF).filter("start = 0").orderBy("sequence_id", "offset").collect()
    got = [r.doc_id for r in pieces]
    assert got == want and len(got) > len(set(got))
    first, second = got[: len(got) // 2], got[len(got) // 2 :]
    small = [sum(i >= 900 for i in half) for half in (first, second)]
    assert min(small) > 0.8 * max(small)
    assert all(a != b for a, b in zip(got, got[1:]))


def test_mixing_sql_takes_a_null_source_as_one_of_its_own(spark, tmp_path):
    rows = [(i, f"w{i} " * (i % 9 + 1), "en", (None, "null", "web", "web", "books")[i % 5], 10) for i in range(300)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(queries.QUERIES["op2_temperature_mixing"](spark, str(tmp_path)), con, mixing.SQL) == ""
