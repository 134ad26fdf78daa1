import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from hearth.session import get_spark
    s = get_spark("local[4]", app="hearth-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_smoke():
    from compare import duck
    return duck(SMOKE)


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="hearth-test-")
