import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def make_session(cpus: str = "8"):
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("muster-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="muster-test-"))
        .getOrCreate()
    )


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
