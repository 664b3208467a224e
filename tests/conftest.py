import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from indexkit.session import get_spark
    s = get_spark("indexkit-tests", "local[*]", 8,
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="indexkit-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="indexkit-test-")
