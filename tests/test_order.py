"""Row positions, skew-safe joins, splits and running minima against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from pairloom.operators import best, splits
from pairloom.operators.joins import attach, lookup
from pairloom.operators.rowindex import hash_order_index, indexed, row_index
from pairloom.session import store


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, n=3000):
    """Key 7 holds a third of the rows, the others are spread."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("bigint").alias("k"), F.col("id").alias("v")
    )


def test_row_index_is_a_bijection_in_order(spark):
    df, n = indexed(skewed(spark), ["k", "v"])
    got = [(r.k, r.v) for r in sorted(df.collect(), key=lambda r: r.idx)]
    assert n == 3000
    assert sorted(r.idx for r in df.select("idx").collect()) == list(range(3000))
    assert got == sorted(got)


def test_row_index_survives_repartition(spark):
    a = row_index(skewed(spark), ["v"]).select("v", "idx")
    b = row_index(skewed(spark).repartition(13), ["v"]).select("v", "idx")
    assert a.exceptAll(b).count() == 0


def test_row_index_spreads_a_hot_key(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = row_index(skewed(spark, 30000), ["k", "v"])
        parts = df.filter("k = 7").select(F.spark_partition_id().alias("p")).distinct().count()  # one file each
        assert parts >= 3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("few", [1024, 3])
def test_row_index_restarts_per_group(spark, monkeypatch, few):
    monkeypatch.setattr("pairloom.operators.rowindex._FEW_GROUPS", few)
    df = row_index(skewed(spark), ["v"], partition_by=["k"], name="i", size_name="n")
    want = {}
    for r in sorted(skewed(spark).collect(), key=lambda r: r.v):
        want.setdefault(r.k, []).append(r.v)
    for r in df.collect():
        assert want[r.k][r.i] == r.v and len(want[r.k]) == r.n


def test_row_index_of_nothing(spark):
    df, n = indexed(skewed(spark).filter("v < 0"), ["v"])
    assert n == 0 and df.count() == 0


def test_row_index_plan_has_no_single_partition(spark):
    assert "SinglePartition" not in plan_of(row_index(skewed(spark), ["k", "v"]))


def test_hash_order_is_a_permutation_per_epoch(spark):
    keys = spark.range(500).withColumn("epoch", F.explode(F.array(F.lit(0), F.lit(1))))
    one = hash_order_index(keys, "id", seed=42, within=["epoch"])
    two = hash_order_index(keys.repartition(5), "id", seed=42, within=["epoch"], prefix=1)
    assert "SinglePartition" not in plan_of(one)
    assert one.exceptAll(two).count() == 0
    orders = {e: [r.id for r in sorted(one.filter(F.col("epoch") == e).collect(), key=lambda r: r.idx)] for e in (0, 1)}
    assert sorted(orders[0]) == sorted(orders[1]) == list(range(500))
    assert orders[0] != orders[1]


@pytest.mark.parametrize("heavy", [1, 2, 1024])
@pytest.mark.parametrize("how", ["left", "inner", "semi"])
def test_attach_equals_join(spark, heavy, how):
    left = skewed(spark).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, -1L AS v"))
    table = skewed(spark).groupBy("k").agg(F.count("*").alias("w"), F.sum("v").alias("s")).filter("k % 2 = 1")
    got = attach(left, table, ["k"], weight="w", spread=["v"], how=how, heavy=heavy)
    want = left.join(table.drop("w"), "k", {"left": "left", "inner": "inner", "semi": "left_semi"}[how]).select(got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_attach_spreads_the_hot_key(spark):
    """With adaptive execution and broadcasts off, no shuffle task gets the third of the rows."""
    left = skewed(spark, 24000)
    table = left.groupBy("k").agg(F.count("*").alias("w"), F.sum("v").alias("s"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = attach(left, table, ["k"], weight="w", spread=["v"], heavy=1)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 24000 / 8 * 1.5
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("rows", [0, 10**6])
def test_lookup_both_ways(spark, monkeypatch, rows):
    monkeypatch.setattr("pairloom.operators.joins.BROADCAST_ROWS", rows)
    table = store(skewed(spark).groupBy("k").agg(F.count("*").alias("w"), F.max("v").alias("m")), "t")
    got = lookup(skewed(spark), table, ["k"], weight="w", spread=["v"])
    assert got.filter("m IS NULL").count() == 0 and got.count() == 3000


def test_prior_min_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(r, s, rng.choice([None, rng.randint(0, 60) / 10])) for r in ("a", "b") for s in rng.sample(range(400), 150)]
    df = spark.createDataFrame(rows, "run STRING, step BIGINT, v DOUBLE")
    got = best.prior_min(df, run=["run"], step="step", value="v", out="p", block=5, levels=2).collect()
    for r in got:
        earlier = [v for run, s, v in rows if run == r.run and s < r.step and v is not None]
        assert r.p == (min(earlier) if earlier else None)


def test_best_flag_is_strict(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 2.0), ("a", 3, 1.0), ("a", 4, None)], "run STRING, step BIGINT, eval_loss DOUBLE")
    flags = {r.step: r.is_best for r in best.best_so_far(df).collect()}
    assert flags == {1: True, 2: False, 3: True, 4: False}
    assert best.best_checkpoint(df).first()["best_step"] == 3


def test_best_ties(spark):
    points = spark.createDataFrame([("a", 5, 1.0), ("a", 2, 1.0)], "run STRING, step BIGINT, eval_loss DOUBLE")
    assert best.best_checkpoint(points).first()["best_step"] == 2
    answers = spark.createDataFrame([(1, 3, "x", 0.5), (1, 2, "y", 0.5)], "prompt_id BIGINT, cand_id BIGINT, response STRING, reward DOUBLE")
    assert best.best_of_n(answers).first()["response"] == "y"


def test_default_plan_leaves_the_known_gap(spark):
    report = {r.stage: r for r in splits.split_report(spark.range(40000).withColumnRenamed("id", "idx"), splits.DEFAULT_PLAN).collect()}
    assert report["gap_before_policy"].range == "20000-24999"
    assert [report[s].n_rows for s in ("sft", "reward", "policy")] == [10000, 10000, 5000]


def test_slices_clamp_and_heads_check(spark):
    df = spark.range(50).withColumnRenamed("id", "idx")
    assert splits.slice_rows(df, 40, 90).count() == 10
    assert splits.slice_rows(df, 90, 100).count() == 0
    with pytest.raises(ValueError):
        splits.head_n(df, 60, strict=True)


def test_plans_must_be_disjoint():
    with pytest.raises(ValueError):
        splits.StagePlan((splits.Stage("a", 0, 10), splits.Stage("b", 5, 20)))


def test_leakage_finds_copies_across_stages_only(spark):
    rows = [(0, "sft", "Hello  World"), (1, "sft", "hello world"), (2, "reward", " hello\nworld "), (3, "reward", "other"), (4, "reward", "other")]
    df = spark.createDataFrame(rows, "idx BIGINT, stage STRING, prompt STRING")
    found = splits.leakage_audit(splits.hash_texts(df, ("prompt",)), ("prompt",)).collect()
    assert sorted(r.idx for r in found) == [0, 1, 2]


def test_overlapping_rows(spark):
    df = spark.createDataFrame([(0, "a"), (0, "a"), (1, "a"), (1, "b")], "idx BIGINT, stage STRING")
    assert [r.idx for r in splits.overlapping_rows(df).collect()] == [1]
