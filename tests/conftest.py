import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from flowatlas.session import ensure_checkpoint_dir, get_spark
    fresh = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    s = get_spark("local[4]", 4, extra={"spark.checkpoint.dir": fresh})
    ensure_checkpoint_dir(s, fresh)
    yield s
    s.stop()
