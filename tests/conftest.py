from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from quartier.session import SETTINGS  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    builder = SparkSession.builder.master("local[8]").appName("tests").config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
    builder = builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
    builder = builder.config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture(scope="session")
def as_rows():
    return rows
