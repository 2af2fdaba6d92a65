from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from shopline.session import checkpoint_dir, get_session
    s = get_session("local[4]", app="shopline-tests", shuffle_partitions=8,
                    extra={"spark.driver.memory": "4g"})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="shopline-test-")


@pytest.fixture(autouse=True)
def broadcast_threshold(spark):
    """Tests share a session: the threshold that a test sets must not change the plans of those after it."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    yield
    if spark.conf.get(key) != before:
        spark.conf.set(key, before)
