"""Where intermediate rows are kept, and what is left of a step that wrote them."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from checks.tables import staging_dir
from ordertide.session import CLEANUP, staged


def _session(master):
    settings = {}
    conf = SimpleNamespace(get=settings.get, set=settings.__setitem__)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_a_cluster_needs_a_shared_folder():
    assert staging_dir(_session("local[2]"))
    with pytest.raises(ValueError):
        staging_dir(_session("spark://host:7077"))


def _shuffle_blocks(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {name for name in blocks.mkString(" ").split() if name.startswith("shuffle_")}


def test_shuffle_files_of_a_staged_step_go_with_it(spark, tmp_path):
    before, setting = _shuffle_blocks(spark), spark.conf.get(CLEANUP)
    made = staged(spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count(), str(tmp_path))
    assert not _shuffle_blocks(spark) - before and spark.conf.get(CLEANUP) == setting
    assert made.count() == 7
    failed = spark.range(10).select(F.raise_error(F.lit("no")).cast("int").alias("x"))
    with pytest.raises(Exception):
        staged(failed, str(tmp_path))
    assert spark.conf.get(CLEANUP) == setting
