import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from corpusmill.session import session

    base = tmp_path_factory.mktemp("spark")
    s = session(
        "local[4]", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"file://{base}/shared", "spark.sql.warehouse.dir": f"{base}/warehouse"}
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
