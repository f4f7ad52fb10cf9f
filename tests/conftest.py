import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from eventflow.session import tune

    session = (
        SparkSession.builder.master("local[8]")
        .appName("eventflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("ckpt")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("wh")))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()
