import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from gridloom.session import session

    s = session("tests", cpus=4, memory="4g")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    return s
