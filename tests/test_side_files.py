"""JSON loading with quarantine, manifests in run folders, checkpoint manifests, the refined reward head."""

import json
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.operators import models
from pairloom.session import store, temporary
from pairloom.sources import comparisons, manifests


def test_json_lines_are_kept_or_refused_with_a_reason(spark, tmp_path):
    good = {"prompt": "p \"q\"\n", "chosen": "", "rejected": "é", "idx": 7}
    lines = [
        (json.dumps(good), "kept"),
        (json.dumps(good | {"idx": "x"}), "kept"),
        (json.dumps({k: v for k, v in good.items() if k != "idx"} | {"more": [1]}), "kept"),
        (json.dumps(good)[:-2], "malformed"),
        ("not json", "malformed"),
        ("{} {}", "missing prompt"),
        ("[1, 2]", "not an object"),
        ('"text"', "not an object"),
        ("null", "not an object"),
        ("12", "not an object"),
        (json.dumps(good | {"chosen": 5}), "not text chosen"),
        (json.dumps(good | {"chosen": True}), "not text chosen"),
        (json.dumps(good | {"prompt": {"a": 1}}), "not text prompt"),
        (json.dumps(good | {"rejected": None}), "null rejected"),
        (json.dumps({"chosen": "c", "rejected": "r"}), "missing prompt"),
        ("{}", "missing prompt"),
    ]
    (tmp_path / "a.json").write_text("\n".join(["", "   "] + [x for x, _ in lines] + ["\t", ""]))
    rows = comparisons.read_json_rows(spark, str(tmp_path), extra="idx BIGINT").collect()
    assert sorted((r.raw or "", r.reason) for r in rows) == sorted((x if why != "kept" else "", why) for x, why in lines)
    kept, bad = comparisons.load_json(spark, str(tmp_path), extra="idx BIGINT")
    assert kept.columns == ["prompt", "chosen", "rejected", "idx"] and bad.columns == ["reason", "raw", "file"]
    assert sorted(r.idx or -1 for r in kept.collect()) == [-1, -1, 7]
    assert all(tuple(r)[:3] == ("p \"q\"\n", "", "é") for r in kept.collect())
    assert bad.count() == 13 and all(r.file.endswith("a.json") for r in bad.collect())
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "b.json").write_text("\n\n")
    assert comparisons.read_json_rows(spark, str(tmp_path / "none")).count() == 0


def test_manifest_files_of_runs(spark, tmp_path):
    files = {
        "a": '{\n  "base": "x"\n}', "b": '{"base": nul', "c": '{"other": 1}', "d": '{"base": null}', "e": '{"base": {"k": 1}}', "f": "  ", "g": "[1]", "run 7+é": '{"base": "y"}',
    }
    for run, text in files.items():
        (tmp_path / f"run={run}" / "deep").mkdir(parents=True)
        (tmp_path / f"run={run}" / "deep" / "ignored.txt").write_text("{}")
        (tmp_path / f"run={run}" / "config.json").write_text(text)
    (tmp_path / "run=a" / "config2.json").write_text('{"base": "newer"}')
    runs = spark.createDataFrame([(r,) for r in [*files, "h", None]], "run STRING")
    got = manifests.folder_lookup(runs, str(tmp_path), key="run", name="base", ddl="STRUCT<k: BIGINT>", default=None, folder="run={}", glob="*.json")
    assert got.filter("run = 'e'").first()["reason"] == "found"
    got = manifests.folder_lookup(runs, str(tmp_path), key="run", name="base", ddl="BIGINT", default=-1, folder="run={}", glob="config.json")
    assert {r.run: r.reason for r in got.collect()}["a"] == "wrong type"
    got = manifests.folder_lookup(runs, str(tmp_path), key="run", name="base", ddl="STRING", default="sft", folder="run={}", glob="*.json", out="base_path")
    rows = {r.run: (r.base_path, r.reason) for r in got.collect()}
    assert rows.pop("e")[1] == "found"
    assert rows == {
        "a": ("newer", "found"), "b": ("sft", "malformed"), "c": ("sft", "no key"), "d": ("sft", "no key"), "f": ("sft", "empty"), "g": ("sft", "malformed"),
        "run 7+é": ("y", "found"), "h": ("sft", "absent"), None: ("sft", "absent"),
    }
    gone = manifests.folder_lookup(runs, str(tmp_path / "nowhere"), key="run", name="base", ddl="STRING", default="sft")
    assert {(r.base, r.reason) for r in gone.collect()} == {("sft", "absent")}


def test_checkpoints_know_their_run_so_far(spark, tmp_path):
    losses = [5.0, 4.0, 6.0, 2.0, 1.0, 9.0, 0.5, 0.5, 3.0]
    rows = [("a", k + 1, x) for k, x in enumerate(losses)] + [("b/1", 1, 1.0), ("b/1", 2, 1.0)]
    log = spark.createDataFrame(rows, "run STRING, step BIGINT, loss DOUBLE")
    states = manifests.checkpoint_states(log, every=2)
    manifests.write_checkpoints(states, str(tmp_path / "c"), settings={"base_sft_model": "sft", "reward_model": "reward"})
    back = manifests.read_manifests(spark, str(tmp_path / "c"), manifests.CHECKPOINT_SCHEMA).orderBy("run", "epoch").collect()
    assert [(r.run, r.epoch, r.total_steps, r.eval_loss, r.best_loss, r.is_best) for r in back] == [
        ("a", 2, 2, 4.5, 4.5, True), ("a", 4, 4, 4.0, 4.0, True), ("a", 6, 6, 5.0, 4.0, False), ("a", 8, 8, 0.5, 0.5, True), ("b/1", 2, 2, 1.0, 1.0, True),
    ]
    assert back[1].reward_mean == pytest.approx(4.25) and back[1].reward_std == pytest.approx(np.std(losses[:4], ddof=1)) and back[1].last_value == 2.0
    rewards = manifests.checkpoint_states(log.filter("run = 'a'"), every=2, higher_is_better=True).orderBy("step").collect()
    assert [(r.best_loss, r.is_best) for r in rewards] == [(4.5, True), (4.5, False), (5.0, True), (5.0, False)]
    assert {r.model_type for r in back} == {"ppo_checkpoint"} and {r.base_sft_model for r in back} == {"sft"}
    assert len([p for p in (tmp_path / "c").iterdir() if p.is_dir()]) == 2


def test_refined_head_is_the_fixed_point_from_any_start(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(0.4, 2), rnd.gauss(0, 0.05), 1.0], [rnd.gauss(0, 2), rnd.gauss(0.02, 0.05), 1.0]) for i in range(300)] + [(999, None, [1.0, 1.0, 1.0])]
    pairs = spark.createDataFrame(rows, "id BIGINT, chosen_feature ARRAY<DOUBLE>, rejected_feature ARRAY<DOUBLE>")
    d = models.feature_differences(pairs).repartition(3).cache()
    fitted = models.head_weights(models.reward_fit(pairs))
    best = models.refine_head(d, fitted)
    assert best == pytest.approx(fitted, abs=1e-3)
    assert models.refine_head(d, [50.0, -80.0, 3.0]) == pytest.approx(best, abs=1e-9)
    assert abs(best[2]) < 1e-9  # a feature that never differs has no weight
    x = np.array([[c - r for c, r in zip(a, b)] for _, a, b in rows if a])
    gradient = 1e-3 * np.array(best) - (x / (1 + np.exp(x @ best))[:, None]).mean(axis=0)
    assert np.abs(gradient).max() < 1e-9
    with pytest.raises(ValueError):
        models.refine_head(d.limit(0), [0.0, 0.0, 0.0])


def test_a_file_per_run_is_written_in_place(spark, tmp_path):
    """Tasks write the run files where they stay: nothing is left to be moved by the driver, and small data is not put into one task."""
    rows = [("a", '{"k": 1}'), ("b/c", "two\nlines"), ("", "x"), ("d=1", None)]
    df = spark.createDataFrame(rows, "run STRING, value STRING")
    root = tmp_path / "files"
    assert manifests.write_folders(df, str(root), key="run", text="value", folder="run={}") == 4
    assert manifests.write_folders(df, str(root), key="run", text="value", folder="run={}") == 4
    found = {f.parent.name: f.read_text() for f in root.rglob("*") if f.is_file()}
    df.repartition("run").write.partitionBy("run").text(str(tmp_path / "spark"))
    assert found == {f.parent.name: f.read_text() for f in (tmp_path / "spark").rglob("part-*")}
    assert manifests.write_folders(df.limit(0), str(tmp_path / "none"), key="run", text="value") == 0
    got = manifests.folder_lookup(df.select("run"), str(root), key="run", name="k", ddl="BIGINT", default=-1, folder="run={}")
    assert {r.run: (r.k, r.reason) for r in got.collect()}["a"] == (1, "found")


def test_shuffle_files_go_when_a_table_is_written(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = shuffles()
    df = spark.range(0, 1000, 1, 3).groupBy((F.col("id") % 7).alias("k")).count()
    table = store(df, "counted")
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
    for _ in range(50):  # they are deleted beside the job
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, table.collect()))


def test_temporary_tables_go_but_those_kept(spark):
    with temporary("outer"):
        with temporary("inner", "outer"):
            inner, outer, gone = (store(spark.range(3), name) for name in ("inner", "outer", "gone"))
        assert inner.count() == outer.count() == 3
        assert not os.path.exists(gone._stored_path.removeprefix("file://"))
    assert outer.count() == 3 and not os.path.exists(inner._stored_path.removeprefix("file://"))
    free = store(spark.range(3), "free")
    assert free.count() == 3
