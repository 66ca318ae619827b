import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from crmweave.session import prepare_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare_session(session)
    session.stop()


@pytest.fixture(params=["broadcast", "shuffle"])
def join_mode(request, spark):
    """Runs a test twice: lookups small enough to broadcast, and lookups too large for it."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "10485760b" if request.param == "broadcast" else "-1")
    yield request.param
    spark.conf.set(name, before)


@pytest.fixture
def frame(spark, tmp_path):
    """Rows as a frame read from parquet, so that its size is known to the planner."""
    made = iter(range(1000))

    def make(rows, schema):
        path = str(tmp_path / f"frame{next(made)}")
        spark.createDataFrame(rows, schema).write.parquet(path)
        return spark.read.parquet(path)

    return make
