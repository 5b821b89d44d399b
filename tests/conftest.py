import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from tidemill.session import session

    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])
    s = session("tests", spark__master="local[4]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="3g", spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
