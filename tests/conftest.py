import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerflow.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="ledgerflow-tests")
    # Tests own their checkpoint folder (a cluster would set spark.checkpoint.dir).
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="ledgerflow-test-")
