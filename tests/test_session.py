import os

import pytest
from pyspark.sql import functions as F

from peakwise.session import release, shared_path
from peakwise.sources.tables import CLEANUP, write_table


class FakeContext:
    master = "spark://host:7077"
    applicationId = "app"


class FakeSession:
    sparkContext = FakeContext()

    def __init__(self, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}


def test_shared_paths_are_new_and_below_the_named_folder():
    session = FakeSession("hdfs://shared/")
    a, b = shared_path(session, "x"), shared_path(session, "x")
    assert a != b and a.startswith("hdfs://shared/x-")


def test_a_cluster_must_name_its_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_path(FakeSession(None), "x")


def test_a_local_session_writes_below_its_warehouse():
    session = FakeSession(None)
    session.sparkContext = type("Local", (), {"master": "local[2]", "applicationId": "local"})()
    session.conf["spark.sql.warehouse.dir"] = "file:/data/warehouse"
    assert shared_path(session, "x").startswith("file:/data/warehouse/scratch/x-")


def test_a_run_s_tables_are_removed(spark):
    release(spark)
    path = shared_path(spark, "table")
    table = write_table(spark.range(5), path)
    assert table.count() == 5 and os.path.exists(path.removeprefix("file:"))
    assert release(spark) == 1
    assert not os.path.exists(path.removeprefix("file:"))
    assert release(spark) == 0


def test_writing_a_table_leaves_no_shuffle_files(spark, work):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = files.getAllFiles().size()
    grouped = spark.range(20_000).groupBy((F.col("id") % 5000).alias("key")).count()
    table = write_table(grouped.repartition(16, "count"), f"{work}/grouped")
    assert files.getAllFiles().size() <= before
    assert table.count() == 5000
    assert spark.conf.get(CLEANUP, None) in (None, "false")
