import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lakefold.session import build_session  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="lakefold-tests-")
    s = build_session("local[4]", shuffle_partitions=8, extra={"spark.checkpoint.dir": scratch})
    yield s
    s.stop()
