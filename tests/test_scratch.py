"""What intermediate steps leave on disk."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from watchledger import scratch as scratch_module
from watchledger.plans import quality
from watchledger.scratch import FREE, Scratch, freed_shuffles, shared_folder
from watchledger.settings import Settings
from workload.context import Context
from workload.models import build_pipeline

FOLDER = "/root/testdata/sf0.001"


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    listed = env.blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {name for name in listed if "/shuffle_" in name}


def left_after(spark, before, seconds):
    """New shuffle files, after waiting for Spark to drop them."""
    for _ in range(seconds * 10):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def dealt(spark):
    return spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()


def folders(root):
    return [d for _, names, _ in os.walk(root.removeprefix("file:")) for d in names]


def test_a_staged_table_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    staged = Scratch(spark, str(tmp_path), free=True).stage(dealt(spark), "sums")
    assert not left_after(spark, before, seconds=10)
    assert staged.count() == 100
    assert spark.conf.get(FREE, None) is None


def test_the_setting_is_put_back(spark):
    spark.conf.set(FREE, "false")
    inner = threading.Barrier(2)

    def writer():
        with freed_shuffles(spark):
            inner.wait()
            assert spark.conf.get(FREE) == "true"
            inner.wait()

    try:
        other = threading.Thread(target=writer)
        other.start()
        with freed_shuffles(spark):
            inner.wait()
            inner.wait()
        other.join()
        assert spark.conf.get(FREE) == "false"
        with pytest.raises(ValueError), freed_shuffles(spark):
            raise ValueError
        assert spark.conf.get(FREE) == "false"
    finally:
        spark.conf.unset(FREE)
    assert spark.conf.get(FREE, None) is None


def test_steps_go_once_their_table_is_stored(spark):
    c = Context(spark, FOLDER, Settings())
    with c.scratch:
        rows = c.fact_revenue_attribution.count()
        assert c.fact_consumption.count() > rows > 0
        kept = {name[4:] for name in folders(c.scratch.root)}
        assert {"fact_order", "fact_consumption", "fact_revenue_attribution"} <= kept
        assert not [name for name in kept if "steps" in name or "ordered" in name]


def test_tests_of_a_build_one_by_one_or_at_once(spark, scratch):
    c = Context(spark, FOLDER, Settings())
    with c.scratch:
        tables = c.model_tables()
        at_once = quality.build_tests(tables)
        staged = quality.build_tests(tables, scratch)
        assert staged.schema.names == at_once.schema.names
        rows = sorted(map(str, staged.collect()))
        assert rows == sorted(map(str, at_once.collect()))
        assert len(rows) == 50
        # Stored counts are all that is left to read.
        assert all(scratch.root.rsplit("/", 1)[1] in f for f in staged.inputFiles())


def test_sums_of_a_build_are_stored_table_by_table(spark):
    c = Context(spark, FOLDER, Settings())
    with c.scratch:
        sums = build_pipeline(c)
        assert sums.count() == 15
        assert all("-sums-" in f for f in sums.inputFiles())
        assert not [name for name in folders(c.scratch.root) if name.endswith("steps")]


@pytest.fixture
def mount(spark, tmp_path, monkeypatch):
    """A checkpoint folder without a store, as a cluster's session sees it."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://head:7077")
    monkeypatch.setattr(scratch_module, "_tried", {}, raising=False)
    named(spark, monkeypatch, f"file:{tmp_path}")
    return tmp_path


def named(spark, monkeypatch, folder):
    """Have the session's settings name the folder, or none."""
    get = type(spark.conf).get
    key = "spark.checkpoint.dir"
    monkeypatch.setattr(
        type(spark.conf), "get", lambda self, k, *a: folder if k == key else get(self, k, *a)
    )
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: folder)


def test_a_mount_that_all_machines_share_is_taken(spark, mount):
    assert shared_folder(spark) == f"file:{mount}"
    assert not list(mount.iterdir())
    with Context(spark, FOLDER, Settings()).scratch as scratch:
        assert scratch.stage(dealt(spark), "sums").count() == 100


def test_a_mount_is_tried_out_once_for_the_same_hosts(spark, mount, monkeypatch):
    trials, stage = [], Scratch.stage
    monkeypatch.setattr(
        Scratch, "stage", lambda self, df, name: trials.append(name) or stage(self, df, name)
    )
    for _ in range(3):
        shared_folder(spark)
    assert trials == ["trial"]
    for hosts in scratch_module._tried.values():
        hosts.clear()
    shared_folder(spark)
    assert trials == ["trial", "trial"]


def test_a_folder_that_lacks_what_executors_wrote_is_refused(spark, mount, monkeypatch):
    stage = Scratch.stage

    def elsewhere(self, df, name):
        """Where one file is on the disk of another machine."""
        stage(self, df, name)
        written = mount.glob("run-*/*-trial/part-*")
        next(written).unlink()
        return self.spark.read.schema(df.schema).parquet(str(next(mount.glob("run-*/*-trial"))))

    monkeypatch.setattr(Scratch, "stage", elsewhere)
    for _ in range(2):
        with pytest.raises(RuntimeError, match="local to each machine"):
            shared_folder(spark)
    assert not list(mount.iterdir())


def test_a_cluster_without_a_folder_is_refused(spark, mount, monkeypatch):
    named(spark, monkeypatch, None)
    with pytest.raises(RuntimeError, match="set spark.checkpoint.dir"):
        shared_folder(spark)
