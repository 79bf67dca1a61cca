import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.01"
# The registered queries train the library's full models; here small ones of the same kinds do.
MODEL_SETTINGS = {"trees": 20, "depth": 5, "rounds": 5, "boost_depth": 3, "leaves": 5}


@pytest.fixture(scope="session", autouse=True)
def small_models():
    import __spark_entry__ as entry

    entry.MODEL_SETTINGS.update(MODEL_SETTINGS)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def pipe(spark, sf):
    import __spark_entry__ as entry

    return entry._pipe(spark, sf)
