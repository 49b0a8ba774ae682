import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from topicflow.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = configure(SparkSession.builder.master("local[4]").appName("topicflow-tests"))
    session = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


TOPIC = "topic string, partition int, offset bigint, timestamp timestamp, value string"


@pytest.fixture(scope="session")
def topic(spark):
    """Payload texts as rows of one topic-partition, one second apart."""
    from pyspark.sql import functions as F

    def make(values, name="t", partition=0, first=0):
        rows = [(name, partition, first + i, first + i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(
            rows, "topic string, partition int, offset bigint, s bigint, value string"
        )
        return df.select(
            "topic", "partition", "offset", F.timestamp_seconds("s").alias("timestamp"), "value"
        )

    return make
