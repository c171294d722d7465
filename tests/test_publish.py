"""Publishing built splits, whole and in versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechset.plans.build_clips import build_split
from speechset.plans.build_steps import build_in_steps, store_utterances
from speechset.plans.publish import publish_built
from speechset.plans.publish_versions import (
    built_dataset, current_version, publish_splits, publish_version, read_published, version_manifest,
)
from tests.conftest import plan, rows
from tests.test_build_steps import _utterances, open_easy, open_strict


def test_publishing_follows_the_last_input(spark, tmp_path):
    folder, target = str(tmp_path / "dev"), str(tmp_path / "out")
    all_rows = _utterances(spark, 12)
    build_split(all_rows, open_easy, folder)
    assert rows(build_split(all_rows.where("original_index < 5"), open_easy, folder)) == [(4, 1, 5)]
    assert rows(publish_built(spark, {"dev": folder}, target, 24000, {"dev": all_rows})) == [("dev", 5, 4)]
    data = spark.read.parquet(f"{target}/data")
    assert not [c for c in data.columns if c.startswith("_")]
    got = {r.original_index: r for r in data.collect()}
    assert set(got) == set(range(5)) and got[3].error and got[3].cloned_audio_fr is None
    assert got[0].audio_en.array == [0.5] and got[0].cloned_audio_fr.sampling_rate == 24000
    build_split(all_rows, open_easy, folder)
    assert rows(publish_built(spark, {"dev": folder, "none": str(tmp_path / "none")}, target)) == [("dev", 12, 11)]
    assert "audio_en" not in spark.read.parquet(f"{target}/data").columns


def _split(spark, n, text="a", split="dev"):
    return spark.range(n).selectExpr(f"'{split}' AS split", "concat('k', id) AS _key", f"concat('{text}', id) AS text", "array(1.5F) AS audio")


def test_only_changed_buckets_are_written(spark, tmp_path):
    target = str(tmp_path / "t")
    assert current_version(spark, target) is None
    with pytest.raises(FileNotFoundError):
        read_published(spark, target)
    assert publish_version(_split(spark, 200), target, buckets=8) == 1
    one = _split(spark, 200).withColumn("text", F.when(F.col("_key") == "k7", "new").otherwise(F.col("text")))
    assert publish_version(one, target) == 2
    manifest = version_manifest(spark, target, 2)
    assert manifest.where("v = 2").count() == 1 and manifest.count() == 8
    assert spark.read.parquet(f"{target}/parts/v=2").count() < 60
    assert read_published(spark, target).where("text = 'new'").count() == 1 and read_published(spark, target, 1).where("text = 'new'").count() == 0
    assert read_published(spark, target).columns == ["text", "audio", "split"]
    # An audio array alone is not compared; a column of its own tells.
    assert publish_version(one.withColumn("_run", F.lit("r2")), target) == 3
    assert version_manifest(spark, target, 3).where("v = 3").count() == 8
    # A new column rewrites its splits; a split that is not given stays as it was.
    assert publish_version(_split(spark, 3, split="eval"), target) == 4
    assert rows(read_published(spark, target).groupBy("split").count()) == [("dev", 200), ("eval", 3)]
    assert publish_version(_split(spark, 0), target) == 5 and rows(read_published(spark, target).groupBy("split").count()) == [("dev", 200), ("eval", 3)]


def test_readers_keep_their_version_when_publishing_fails(spark, tmp_path):
    target = str(tmp_path / "t")
    publish_version(_split(spark, 100), target, buckets=4)
    broken = _split(spark, 100, "b").withColumn("audio", F.when(F.col("_key") == "k50", F.raise_error(F.lit("torn")).cast("array<float>")).otherwise(F.col("audio")))
    for _ in range(2):
        with pytest.raises(Exception, match="torn"):
            publish_version(broken, target)
        assert current_version(spark, target) == 1
        assert read_published(spark, target).where("text LIKE 'a%'").count() == 100
    assert rows(spark.read.json(f"{target}/failures"), "v") == [(2,), (3,)]
    assert publish_version(_split(spark, 100, "b"), target) == 4
    assert read_published(spark, target).where("text LIKE 'b%'").count() == 100


def test_only_named_folders_are_read(spark, tmp_path):
    target = str(tmp_path / "t")
    publish_version(_split(spark, 10), target, buckets=2)
    publish_version(_split(spark, 10, "b"), target)
    assert "dynamicpruning" in plan(read_published(spark, target)).lower()


def test_splits_are_published_one_by_one(spark, tmp_path):
    corpus, folder, target = str(tmp_path / "corpus"), str(tmp_path / "dev"), str(tmp_path / "t")
    store_utterances(_utterances(spark, 20), corpus, step_rows=10, buckets=2)
    report = publish_splits(spark, {"none": (str(tmp_path / "x"), folder), "dev": (corpus, folder)}, target, 24000)
    got = {r.split: r for r in report.collect()}
    assert got["none"].version is None and "FileNotFoundError" in got["none"].report and got["dev"].report == "published"
    assert read_published(spark, target).where("cloned_audio_fr IS NULL").count() == 20
    build_in_steps(spark, corpus, open_strict, folder, publish=lambda step: publish_version(built_dataset(spark, corpus, folder, "dev"), target))
    data = read_published(spark, target)
    assert rows(data.selectExpr("count(*)", "count(cloned_audio_fr)", "count(audio_en)", "count_if(error <> '')")) == [(20, 16, 20, 4)]
    assert not [c for c in data.columns if c.startswith("_")] and np.isclose(data.first().audio_en.array[0], 0.5)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shown = built_dataset(spark, corpus, folder, "dev")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in shown
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
