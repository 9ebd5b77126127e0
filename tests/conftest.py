from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession


def make_spark(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidewatt-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    from tidewatt import configure

    return configure(make_spark())


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
