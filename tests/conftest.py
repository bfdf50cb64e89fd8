import contextlib
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@contextlib.contextmanager
def planned_without_broadcast(spark):
    """Static plans with sort-merge joins, as for tables too large to broadcast."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for k, v in zip(old, ("-1", "false")):
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from marquee.session import build_session
    active = SparkSession.getActiveSession()
    if active is None:
        # tests set their own shared folder only because none is configured
        ckpt, warehouse = (str(tmp_path_factory.mktemp(x)) for x in ("ckpt", "warehouse"))
        spark = build_session("local[8]", shuffle_partitions=8,
                              extra={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": warehouse,
                                     "spark.driver.memory": "8g"})
    else:
        spark = active
    yield spark
    spark.stop()
