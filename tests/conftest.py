import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_TEST = os.environ.get("TESSERA_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tessera.session import ensure_checkpoint_dir, local_session

    s = local_session(cores="*", shuffle_partitions=8, app="tessera-tests")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SF_TEST
