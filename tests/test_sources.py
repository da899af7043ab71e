from __future__ import annotations

from pathlib import Path

import pytest
from conftest import rows

from larder.sources import SOURCE_SCHEMAS, conform, read_tables, scope, stage, unstage
from larder.sources.staging import shared_dir
from workload import market_queries


def test_read_tables_from_files_and_catalog(spark, frame, tmp_path):
    df = frame("code string, boxitem int, other int", ("A", 3, 1))
    df.write.parquet(f"{tmp_path}/box")
    df.createOrReplaceTempView("my_boxes")
    for tables in (
        read_tables(spark, {"box_item": f"{tmp_path}/box"}, "parquet"),
        read_tables(spark, {"box_item": "my_boxes"}),
    ):
        box = conform(tables)["box_item"]
        assert box.schema.simpleString() == SOURCE_SCHEMAS["box_item"].simpleString()
        assert rows(box) == [("A", 3.0)]


def test_unknown_roles_are_refused(spark):
    with pytest.raises(ValueError, match="prices"):
        read_tables(spark, {"prices": "x"})


def test_week_column(frame):
    df = frame("date_string_backwards string, wk string, running_week int, running_quarter int", ("d", "w", 1, 2))
    assert rows(conform({"calendar": df}, "wk")["calendar"]) == [("d", "w", 1, 2)]


def test_stage_writes_to_the_shared_folder(spark, frame):
    staged = stage(frame("a int, b string", (1, "x"), (2, None)), "test")
    assert rows(staged) == [(1, "x"), (2, None)]
    assert all(shared_dir(spark) in file for file in staged.inputFiles())
    unstage(staged)
    assert not [file for file in staged.inputFiles() if Path(file.removeprefix("file://")).exists()]


def test_unstage_leaves_other_files(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/own")
    df = spark.read.parquet(f"{tmp_path}/own")
    unstage(df)
    assert df.count() == 3


def bare(master):
    class Bare:
        class conf:  # noqa: N801
            get = staticmethod(lambda name, default=None: {"spark.sql.warehouse.dir": "s3://w"}.get(name, default))

        class sparkContext:  # noqa: N801
            getCheckpointDir = staticmethod(lambda: None)

    Bare.sparkContext.master = master
    return Bare


def test_one_process_needs_no_checkpoint_folder():
    assert shared_dir(bare("local[4]")) == shared_dir(bare("local")) == "s3://w"


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_no_machine_local_folder_on_a_cluster(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(bare(master))


def staged_folders(spark):
    return {p.name for p in Path(shared_dir(spark).removeprefix("file://"), "larder").glob("*")}


def test_scope_removes_what_is_staged_inside(spark, frame, tmp_path):
    outer = stage(frame("a int", (1,)), "outer")
    before = staged_folders(spark)
    with scope(spark):
        inner = stage(frame("a int", (2,)), "inner")
        with scope(spark):
            stage(frame("a int", (3,)), "innermost")
        assert len(staged_folders(spark)) == len(before) + 1
        inner.write.parquet(f"{tmp_path}/out")
    with pytest.raises(ZeroDivisionError), scope(spark):
        stage(frame("a int", (4,)), "failing")
        1 / 0  # noqa: B018
    assert staged_folders(spark) == before
    assert rows(outer) == [(1,)] and rows(spark.read.parquet(f"{tmp_path}/out")) == [(2,)]


def test_nothing_is_left_of_a_query(spark):
    before = staged_folders(spark)
    with scope(spark):
        assert market_queries.market_pool_recipes(spark, "/root/testdata/sf0.001").count()
        assert len(staged_folders(spark)) > len(before)
    assert staged_folders(spark) == before
