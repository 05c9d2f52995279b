from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from jobmart.session import SETTINGS

    builder = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.ui.enabled", "false").config("spark.driver.memory", "6g")
               .config("spark.sql.shuffle.partitions", "4"))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
