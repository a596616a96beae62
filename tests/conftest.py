import importlib
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lakeops.session import local_session

    session = local_session("tests", "8")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    folder = "/root/testdata/sf0.001"
    if not Path(folder).exists():
        pytest.skip("driver tables not present")
    return folder


@pytest.fixture(scope="session")
def duck(sf):
    try:
        importlib.import_module("duckdb")
    except ImportError:
        sys.path.append("/opt/oracle")
        pytest.importorskip("duckdb")
    from check_queries import connect

    return connect(sf)


@pytest.fixture
def many_blocks(spark):
    """Keep all shuffle partitions, so that small groups are cut into blocks too."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
