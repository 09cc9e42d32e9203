from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pluvio.session import build_session

    scratch = tempfile.mkdtemp(prefix="pluvio-test-")
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="pluvio-tests",
                      extra={"spark.checkpoint.dir": scratch + "/ckpt",
                             "spark.local.dir": scratch + "/local"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from pluvio.session import work_path

    return work_path(spark, "tests", unique=True)
