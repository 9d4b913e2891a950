from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from ledgerline.plans.warehouse import Warehouse  # noqa: E402
from ledgerline.session import build_session, scratch_path  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "ledgerline-tests",
        "local[8]",
        {
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "1000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark):
    return Warehouse(spark, scratch_path(spark, "tests"))
