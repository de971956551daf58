import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from eventmart.session import create_session
    session = create_session("tests", None, {}, **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.driver.memory": "6g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
