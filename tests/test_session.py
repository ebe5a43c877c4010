import os

import pytest

from marketpulse.session import clear_scratch, ensure_checkpoint_dir, is_local, scratch_path


def test_scratch_paths_live_under_the_shared_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    assert base == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(base + "/marketpulse/x-") and a != b


def test_local_session_sizes_shuffle_partitions(spark):
    # the test session asks for 8 shuffle partitions; AQE and UTC come from the defaults
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 8
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
    assert is_local("local") and is_local("local[8]") and is_local("local[*]")
    assert not is_local("local-cluster[2,1,1024]") and not is_local("yarn")


def test_clear_scratch(spark):
    a = scratch_path(spark, "gone")
    spark.range(3).write.parquet(a)
    assert os.path.isdir(a)
    clear_scratch(spark)
    assert not os.path.exists(a)
