"""Folders of intermediate tables."""

import os

import pytest

from gridmetrics.workspace import new_folder, passing_folders, stored


def _local(path):
    return path.removeprefix("file:")


def test_passing_folders_go(spark, tmp_path):
    outer = new_folder(spark, "outer")
    with passing_folders(spark):
        frame = stored(spark.range(5).toDF("n"))
        (path,) = {os.path.dirname(file) for file in frame.inputFiles()}
        with passing_folders(spark):
            inner = new_folder(spark, "inner")
            assert os.path.exists(_local(inner))
        assert not os.path.exists(_local(inner))
        frame.write.parquet(str(tmp_path / "kept"))
    assert not os.path.exists(path.removeprefix("file://").removeprefix("file:"))
    assert os.path.exists(_local(outer))
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 5


def test_folders_go_after_a_failure_too(spark):
    with pytest.raises(RuntimeError), passing_folders(spark):
        path = new_folder(spark, "failed")
        raise RuntimeError
    assert not os.path.exists(_local(path))
