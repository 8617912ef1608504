import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpusmill.session import build_session, ensure_checkpoint_dir  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="corpusmill-tests",
                      conf={"spark.sql.shuffle.partitions": "8"})
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="corpusmill-test-")
