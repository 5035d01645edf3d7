import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cascara.session import build_session

    # spark.checkpoint.dir comes from the environment's Spark defaults when
    # set there; otherwise the library falls back to a private temp folder
    # (local mode only).
    s = build_session("local[4]", app_name="cascara-tests", shuffle_partitions=8)
    yield s
    s.stop()
