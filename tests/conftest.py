import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from candlewick.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    session = build_session("local[*]", app_name="candlewick-tests", shuffle_partitions=8, extra_conf={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))})
    yield session
    session.stop()
