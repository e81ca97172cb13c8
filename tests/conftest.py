from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from lakestrata.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.01"
SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "lakestrata-tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
            "spark.sql.maxMetadataStringLength": "5000",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
