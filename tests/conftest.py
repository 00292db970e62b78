from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from check import local_scratch  # noqa: E402
from kinloom.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    settings = {
        "spark.master": "local[4]",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.executorEnv.PYTHONPATH": ROOT,
        **local_scratch(),
    }
    built = session("tests", shuffle_partitions=4, **settings)
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


@pytest.fixture(scope="session")
def lines(spark):
    def make(values):
        return spark.createDataFrame([(v,) for v in values], "value string")

    return make


@pytest.fixture
def setting(spark):
    """Change session settings for one test."""
    before = {}

    def change(**values):
        for name, value in values.items():
            name = name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.set(name, value)


def tuples(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def final_plan(df) -> str:
    """Physical plan after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
