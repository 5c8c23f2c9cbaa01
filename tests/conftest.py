import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[4]")
        .appName("sluice-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        # Tests only: the session names no shared folder, so give it one.
        d = tempfile.mkdtemp(prefix="sluice-test-ckpt-")
        session.conf.set("spark.checkpoint.dir", d)
        session.sparkContext.setCheckpointDir(d)
    yield session
    session.stop()


@pytest.fixture()
def workdir(spark):
    from sluice.workspace import new_dir

    return new_dir(spark, "tests")
