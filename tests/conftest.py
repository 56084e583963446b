import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderlake.lake import SESSION_CONF, Lake  # noqa: E402


def build_session(cpus="8", memory="6g"):
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("orderlake-tests")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="orderlake-warehouse-"))
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def spark():
    session = build_session()
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
