import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from riskweave.session import ensure_checkpoint_dir, local_session

    s = local_session("*", shuffle_partitions=8)
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
