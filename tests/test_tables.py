"""Where intermediate tables go, and that they go away."""

import os
import time

import pytest

from lossledger.sources.tables import current_table, drop_old_versions, materialise, publish, published, replace_table, work_folder, work_tables


class _Conf:
    def __init__(self, folder):
        self._folder = folder

    def get(self, key, default=None):
        return self._folder if key == "spark.checkpoint.dir" and self._folder else default


class _Session:
    def __init__(self, master, folder=None):
        self.conf = _Conf(folder)
        self.sparkContext = type("C", (), {"master": master, "applicationId": "app-1"})


def test_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError):
        work_folder(_Session("spark://host:7077"))
    with pytest.raises(ValueError):
        work_folder(_Session("local-cluster[2,1,1024]"))
    assert work_folder(_Session("spark://host:7077", "hdfs:///shared")) == "hdfs:///shared"
    assert work_folder(_Session("local[4]")).endswith("app-1")


def test_tables_of_a_block_are_dropped_at_its_end(spark):
    with work_tables(spark) as folder:
        table = materialise(spark.range(5).toDF("n"), "numbers")
        assert table.count() == 5 and os.listdir(folder)
    assert not os.path.exists(folder)


def test_the_result_of_a_block_outlives_it(spark):
    with work_tables(spark) as outer:
        with work_tables(spark) as inner:
            numbers = materialise(spark.range(5).toDF("n"), "numbers")
            sums = materialise(numbers.groupBy().sum("n"), "sums", outside=True)
            assert os.listdir(inner)
        assert not os.path.exists(inner) and [name.split("-")[0] for name in os.listdir(outer)] == ["sums"]
        assert sums.first()[0] == 10
    assert not os.path.exists(outer)


def test_shuffles_behind_a_table_are_removed(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {name for k in range(files.size()) if (name := files.apply(k).getName()).startswith("shuffle_")}

    before, setting = shuffles(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    with work_tables(spark):
        table = materialise(spark.range(1000).repartition(3), "dealt")
        until = time.time() + 20
        while shuffles() - before and time.time() < until:
            time.sleep(0.1)
        assert not shuffles() - before and table.where("id < 10").collect()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def test_a_table_is_replaced_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        current_table(spark, path)
    replace_table(spark.range(5).toDF("n"), path)
    old = current_table(spark, path)
    new = replace_table(old.selectExpr("n + 10 AS n"), path)
    assert sorted(r.n for r in old.collect()) == [0, 1, 2, 3, 4]  # who read the old version still does
    assert sorted(r.n for r in new.collect()) == sorted(r.n for r in current_table(spark, path).collect()) == [10, 11, 12, 13, 14]
    replace_table(current_table(spark, path).where("n > 12"), path)
    assert drop_old_versions(spark, path, keep=1) == 2 and sorted(r.n for r in current_table(spark, path).collect()) == [13, 14]


def test_a_writer_that_fails_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(3).toDF("n"), path)
    before = published(spark, path)

    def dies(folder):
        spark.range(9).toDF("n").write.parquet(folder)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        publish(spark, path, dies)
    assert published(spark, path) == before and current_table(spark, path).count() == 3


def test_writers_at_once_get_numbers_of_their_own(spark, tmp_path):
    path = str(tmp_path / "t")

    def overtaken(folder):
        spark.range(1).toDF("n").write.parquet(folder)
        replace_table(spark.range(2).toDF("n"), path)  # publishes while this one still writes

    publish(spark, path, overtaken)
    assert current_table(spark, path).count() == 1
    assert sorted(os.listdir(os.path.join(path, "_versions")))[-1] >= "000000000002"

    from lossledger.sources import tables

    assert not tables._point(spark, path, 1, "data-x")  # a number is given once
