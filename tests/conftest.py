import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def jobs_run(spark):
    """Counts the jobs started while a function runs."""

    def count(action) -> int:
        tracker, group = spark.sparkContext.statusTracker(), f"count-{id(action)}"
        spark.sparkContext.setJobGroup(group, "counted")
        try:
            action()
            return len(tracker.getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setJobGroup("idle", "")

    return count
