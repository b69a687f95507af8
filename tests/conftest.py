import sys
from itertools import count
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

FOLDER = "/root/testdata/sf0.001"
GROUPS = count()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture
def jobs_of(spark):
    """Run a function and return its result with the number of Spark jobs it started."""
    def run(function):
        group = f"group-{next(GROUPS)}"
        spark.sparkContext.setJobGroup(group, "counted")
        try:
            result = function()
        finally:
            spark.sparkContext.setJobGroup("other", "not counted")
        return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    return run
