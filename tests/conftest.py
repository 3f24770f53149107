from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tw-warehouse-"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from tablewatch.session import shared_dir

    shared_dir(s)  # registers a local checkpoint folder only if the session has none
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from tablewatch.session import scratch_path

    return lambda name="t": scratch_path(spark, name)
