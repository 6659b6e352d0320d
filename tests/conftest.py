import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from docsynth.session import get_spark
    scratch = tempfile.mkdtemp(prefix="docsynth-test-")
    s = get_spark("local[4]", 8, extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                                        "spark.local.dir": os.path.join(scratch, "local"),
                                        "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("driver test data not present")
    return SF_SMALL


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="docsynth-t-")
