import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from cauce.session import get_session
    ckpt = tempfile.mkdtemp(prefix="cauce-test-ckpt-")
    s = get_session("local[*]", shuffle_partitions=8, conf={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setCheckpointDir(ckpt)
    yield s


SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
