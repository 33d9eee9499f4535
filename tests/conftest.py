import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from covstar.session import local_session
    ck = tempfile.mkdtemp(prefix="covstar-ck-")
    s = local_session(4, app="covstar-tests", checkpoint_dir=ck, shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def tmp_root():
    return tempfile.mkdtemp(prefix="covstar-wh-")
