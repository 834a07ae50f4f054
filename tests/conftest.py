import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from wardlens.session import get_spark

    s = get_spark("local[4]", app_name="wardlens-tests", shuffle_partitions=8,
                  extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="wardlens-wh-"),
                         "spark.checkpoint.dir": tempfile.mkdtemp(prefix="wardlens-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh folder for files a test writes."""
    return tempfile.mkdtemp(prefix="wardlens-test-")
