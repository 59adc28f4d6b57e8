from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from possum.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="possum-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="possum-test-ckpt-"),
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="possum-test-wh-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fixture_bundle(spark):
    from possum.sources.adapters import fixture_bundle as fb
    return fb(spark, SF_SMALL)
