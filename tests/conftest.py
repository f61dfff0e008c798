from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [p for p in (ROOT, os.path.join(ROOT, "tests")) if p not in sys.path]

from wellops.session import build_session  # noqa: E402

SF_DIR = os.environ.get("WELLOPS_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session("wellops-tests", master="local[4]", shuffle_partitions=4, extra={
        "spark.checkpoint.dir": str(shared / "work"),
        "spark.sql.warehouse.dir": str(shared / "warehouse"),
        "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def layout(spark, tmp_path):
    from wellops.sinks.layout import Layout, create_landing
    place = Layout(str(tmp_path / "root"))
    create_landing(spark, place)
    return place
