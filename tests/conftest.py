import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from logmill import configure  # noqa: E402
from logmill.schemas import MESSAGES  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def messages_of(spark):
    """Payload texts to messages with offsets 0, 1, 2 ... one second apart."""

    def make(payloads, topic="t", start_offset=0):
        rows = [
            (topic, 0, start_offset + i if start_offset >= 0 else -1, "k", p, datetime(2026, 1, 1, 0, 0, i % 60))
            for i, p in enumerate(payloads)
        ]
        return spark.createDataFrame(rows, MESSAGES)

    return make
