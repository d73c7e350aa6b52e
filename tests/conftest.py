import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from roadflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    ckpt = tmp_path_factory.mktemp("checkpoint")
    session = build_session("local[*]", shuffle_partitions=8,
                            conf={"spark.checkpoint.dir": str(ckpt)})
    yield session
    session.stop()
