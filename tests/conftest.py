import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shiftscore.session import get_session

    s = get_session("local[*]", 8)
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        # Tests only: no shared folder is configured, so use a scratch one.
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shiftscore-test-ckpt-"))
    yield s
