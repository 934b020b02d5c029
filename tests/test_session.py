import os

from conftest import SMALL

from tallyfold.plans import REGISTRY
from tallyfold.session import materialize, scratch, scratch_path


def test_scratch_is_below_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_nothing_is_left_after_a_report(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root))
    with scratch(spark):
        assert REGISTRY["corpus_report"](spark, SMALL).count() > 0
        assert set(os.listdir(root)) > before
    assert set(os.listdir(root)) == before


def test_a_block_inside_a_block_deletes_its_own(spark):
    with scratch(spark):
        outer = materialize(spark.range(3).toDF("id"), "outer")
        with scratch(spark):
            materialize(spark.range(3).toDF("id"), "inner")
        assert outer.count() == 3


def test_the_warehouse_serves_where_no_folder_is_named():
    class Conf:
        def get(self, key, default=None):
            return {"spark.sql.warehouse.dir": "hdfs://store/warehouse/"}.get(key, default)

    class Session:
        conf = Conf()

    assert scratch_path(Session, "x").startswith("hdfs://store/warehouse/_scratch/x-")
