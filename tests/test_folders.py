from types import SimpleNamespace

import pytest

from tallyweave import folders


def session(master, named=None, folder=None):
    state = {"dir": folder}
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: state["dir"], setCheckpointDir=lambda d: state.update(dir=d), getConf=lambda: SimpleNamespace(get=lambda key: named))
    return SimpleNamespace(sparkContext=context)


def test_a_cluster_must_name_the_shared_folder():
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        folders.shared_folder(session("spark://host:7077"))
    with pytest.raises(ValueError):
        folders.shared_folder(session("local-cluster[2,1,1024]"))
    assert folders.shared_folder(session("spark://host:7077", "hdfs://shared")) == "hdfs://shared"
    assert folders.shared_folder(session("yarn", None, "hdfs://set")) == "hdfs://set"


def test_one_machine_has_a_folder_of_its_own():
    assert "spark-checkpoint-" in folders.shared_folder(session("local[4]"))


def test_written_tables_are_deleted_on_demand(spark):
    from pathlib import Path

    folders.clean(spark)
    df = folders.rewritten(spark.range(5).toDF("n"), "some")
    place = Path(df.inputFiles()[0].removeprefix("file://")).parent
    assert place.is_dir() and df.count() == 5
    assert folders.clean(spark) == 1 and not place.exists() and folders.clean(spark) == 0


@pytest.mark.parametrize(("rows", "tasks"), [(0, 1), (1, 1), (100, 1), (101, 2), (950, 10), (5000, 12)])
def test_tasks_that_read_a_checkpoint_follow_its_rows(spark, rows, tasks):
    """Never more than it has partitions, and no row is lost."""
    some = spark.range(0, 5000, 1, 12).where(f"id < {rows}")
    got = folders.checkpoint(some, 100)
    assert got.rdd.getNumPartitions() == tasks and sorted(x.id for x in got.collect()) == list(range(rows))
    assert folders.checkpoint(some).rdd.getNumPartitions() == 12
