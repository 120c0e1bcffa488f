from __future__ import annotations

import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans.pipeline import Layers  # noqa: E402
from strata.session import get_spark, scratch_path  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = get_spark(
        "strata-tests",
        "local[4]",
        4,
        extra={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(shared),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def schema(spark):
    """A fresh catalog schema."""
    name = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{scratch_path(spark, name)}'")
    return name


@pytest.fixture
def layers(spark):
    prefix = f"t{uuid.uuid4().hex[:10]}_"
    return Layers(spark, prefix, scratch_path(spark, "lake")).create()


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plan():
    return plan_text
