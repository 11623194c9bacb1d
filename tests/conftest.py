import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from shelfline.session import local_session, shared_dir  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    return local_session(
        app="shelfline-tests",
        **{"spark.sql.maxMetadataStringLength": "100000", "spark.sql.debug.maxToStringFields": "1000"},
    )


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture
def scratch(spark):
    """A new shared folder for the test."""
    return shared_dir(spark, "test")


def plan_of(df) -> str:
    """The physical plan as text; after an action it is the plan that adaptive execution chose."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    changed = {}

    def change(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)
