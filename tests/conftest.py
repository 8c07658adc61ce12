import os
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [HERE, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark():
    from tallyloom.session import session

    s = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
