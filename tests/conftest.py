import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[4]").appName("barframe-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own checkpoint folder only where the session has none.
    if not s.conf.get("spark.checkpoint.dir", None):
        d = str(tmp_path_factory.mktemp("ckpt"))
        try:
            s.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001
            pass
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
