import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ":".join(p for p in (ROOT, os.environ.get("PYTHONPATH", "")) if p)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    local = tempfile.mkdtemp(prefix="spark-")
    conf = {"spark.master": "local[4]", "spark.driver.memory": "4g", "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.local.dir": local, "spark.checkpoint.dir": f"{local}/checkpoints"}
    session = SparkSession.builder.config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
