import pytest

from ledgerline.session import choose_root, scratch_path, shared_root


def test_choose_root_prefers_context_then_config():
    assert choose_root("file:/ckpt/abc", "/conf", "yarn") == "file:/ckpt/abc"
    assert choose_root(None, "hdfs:///shared/ckpt", "yarn") == "hdfs:///shared/ckpt"


def test_private_folder_only_in_local_mode():
    assert choose_root(None, None, "local[8]") is None
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        choose_root(None, None, "spark://cluster:7077")


def test_scratch_paths_are_unique_under_the_shared_root(spark):
    root = shared_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)
