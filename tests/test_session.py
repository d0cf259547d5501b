from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from flowwarden import session


def fake(master, configured=None, warehouse=None):
    known = {"spark.checkpoint.dir": configured, "spark.sql.warehouse.dir": warehouse}
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, default=None: known.get(name) or default))


def test_shared_folder():
    assert session.shared_dir(fake("yarn", "hdfs:///work", "hdfs:///house")) == "hdfs:///work"
    assert session.shared_dir(fake("local[2]", None, "file:/here/house")) == "file:/here/house/flowwarden-scratch"
    assert session.shared_dir(fake("yarn", None, "hdfs:///house/")) == "hdfs:///house/flowwarden-scratch"
    # A folder of one machine is not shared.
    for warehouse in (None, "/here/house", "file:/here/house"):
        with pytest.raises(ValueError):
            session.shared_dir(fake("yarn", None, warehouse))


def test_durable_table_keeps_values_and_types(spark):
    df = spark.range(10).withColumn("r", F.rand()).withColumn("a", F.array("id"))
    kept = session.durable(df)
    assert kept.dtypes == df.dtypes
    assert sorted(kept.collect()) == sorted(kept.collect()) and kept.count() == 10
