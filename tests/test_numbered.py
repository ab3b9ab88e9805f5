"""Running sums, row offsets, coverage and components against brute force."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from pairloom.operators import components as cc, coverage, prefix, rowindex, splits


def test_running_sums_equal_brute_force(spark):
    rnd = random.Random(1)
    rows = [(r, s, rnd.randint(-5, 9), rnd.random()) for r in ("a", "b") for s in rnd.sample(range(500), 120)]
    df = spark.createDataFrame(rows, "run STRING, step BIGINT, n BIGINT, x DOUBLE").repartition(5)
    for levels in (0, 1, 2, 3):
        got = prefix.sums_before(df, run=["run"], step="step", values=["n", "x"], block=7, levels=levels).collect()
        assert len(got) == len(rows)
        for r in got:
            before = [o for o in rows if o[0] == r.run and o[1] < r.step]
            assert r.n_before == sum(o[2] for o in before) and r.x_before == pytest.approx(sum(o[3] for o in before))


def test_offsets_of_many_partitions_are_a_joined_table(spark):
    """20,000 partitions: the plan names none of them, and no window sees more than a block."""
    sizes = spark.range(20_000).select(F.col("id").alias("__part"), (F.col("id") % 7 + 1).alias("__rows"))
    offsets = rowindex.partition_offsets(sizes, 20_000)
    plan = offsets._jdf.queryExecution().toString()
    assert len(plan) < 60_000 and "array(" not in plan and "SinglePartition" not in plan
    rows = sorted((r["__part"], r["__rows"], r["__rows_before"]) for r in offsets.collect())
    at = 0
    for part, n, before in rows:
        assert before == at
        at += n
    assert len(rows) == 20_000 and prefix.levels_for(20_000) == 1 and prefix.levels_for(2_000_000) == 2


def test_row_index_plan_does_not_grow_with_partitions(spark):
    def size(parts):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            df = rowindex.row_index(spark.range(4000), ["id"])
            assert df.filter("idx <> id").count() == 0
            return len(df._jdf.queryExecution().analyzed().toString())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")

    assert size(64) < size(4) + 200


@pytest.mark.parametrize("every", [1, 4, 50])
def test_moments_at_due_steps(spark, every):
    rnd = random.Random(every)
    rows = [("a", s, 1e6 + rnd.random()) for s in range(1, 131)] + [("b", s, None if s % 3 else rnd.random()) for s in range(1, 23)] + [("c", 1, None)]
    df = spark.createDataFrame(rows, "run STRING, step BIGINT, v DOUBLE").repartition(4)
    for levels in (0, 1, 2):
        got = {(r.run, r.step): r for r in prefix.moments_upto(df, run=["run"], step="step", value="v", every=every, block=3, levels=levels).collect()}
        due = {(r, s) for r, s, _ in rows if s % every == 0}
        assert set(got) == due
        for (run, step), r in got.items():
            seen = [v for o, s, v in rows if o == run and s <= step and v is not None]
            assert r.n == len(seen)
            assert (r["mean"] is None) if not seen else r["mean"] == pytest.approx(statistics.fmean(seen), rel=1e-12)
            assert (r["std"] is None) if len(seen) < 2 else r["std"] == pytest.approx(statistics.stdev(seen), rel=1e-6)


def ranges(positions):
    out = []
    for p in sorted(positions):
        if out and p <= out[-1][1] + 1:
            out[-1][1] = max(p, out[-1][1])
            out[-1][2] += 1
        else:
            out.append([p, p, 1])
    return [tuple(r) for r in out]


@pytest.mark.parametrize("share", [0.05, 0.5, 0.97, 1.0])
def test_coverage_equals_brute_force(spark, share):
    rnd, total = random.Random(int(share * 100)), 600
    rows = [(s, i) for i in range(total) for s in ("sft", "reward", "policy") if (s != "policy" or i > 400) and rnd.random() < share * (1 if s == "sft" else 0.6)]
    rows += [("sft", rows[0][1])] * 3 + [("extra", None)] if rows else []
    df = spark.createDataFrame(rows, "stage STRING, idx BIGINT").repartition(4)
    got = sorted(tuple(r) for r in coverage.coverage_report(df, total + 50, block=5, levels=3).collect())
    want = [(s, *r) for s in ("sft", "reward", "policy") for r in ranges([i for o, i in rows if o == s])]
    used = {i for _, i in rows}
    want += [("(none)", a, b, 0) for a, b, _ in ranges([i for i in range(total + 50) if i not in used])]
    assert got == sorted(want)


def test_coverage_of_nothing_and_of_the_known_plan(spark):
    none = spark.createDataFrame([], "stage STRING, idx BIGINT")
    assert [tuple(r) for r in coverage.coverage_report(none, 10).collect()] == [("(none)", 0, 9, 0)]
    assert coverage.coverage_report(none, 0).count() == 0
    rows = splits.stage_assign(spark.range(32_000).withColumnRenamed("id", "idx"), splits.DEFAULT_PLAN).filter("stage <> 'unused'")
    got = {(r.stage, r.first_idx, r.last_idx, r.n_rows) for r in coverage.coverage_report(rows, 32_000).collect()}
    assert got == {("sft", 0, 9999, 10_000), ("reward", 10_000, 19_999, 10_000), ("policy", 25_000, 29_999, 5000), ("(none)", 20_000, 24_999, 0), ("(none)", 30_000, 31_999, 0)}


def joined(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components_equal_brute_force(spark):
    rnd = random.Random(2)
    path = [(i, i + 1) for i in range(1000, 1130)]
    star = [(5000, i) for i in range(5001, 5400)] + [(i, 7000) for i in range(7001, 7300)]
    loose = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(160)]
    edges = path + star + loose + [(9000, 9000), (1130, 1129), (1130, 1129)]
    df = spark.createDataFrame([*edges, (None, 3), (8000, None)], "x BIGINT, y BIGINT").repartition(6)
    got = {r.node: r.component for r in cc.components(df, a="x", b="y").collect()}
    assert got == joined(edges)
    assert cc.components(df.limit(0), a="x", b="y").count() == 0


def test_no_document_is_on_both_sides(spark):
    rnd = random.Random(3)
    pairs = [(k, 1000 + k % 37 if k % 3 else 1000 + rnd.randint(0, 200)) for k in range(400)]
    df = spark.createDataFrame([*pairs, (None, 1)], "good BIGINT, bad BIGINT")
    out = cc.component_split(df, a="good", b="bad").collect()
    assert len(out) == 401
    sides = {}
    for r in out:
        for d in (r.good, r.bad):
            if r.good is not None:
                sides.setdefault(d, set()).add(r.split)
    assert all(len(s) == 1 for s in sides.values())
    assert {r.split for r in out if r.good is None} == {"train"}
