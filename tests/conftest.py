import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from derrickflow.session import build

    s = build("local[3]", **{"spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": "file://" + str(tmp_path_factory.mktemp("shared"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
