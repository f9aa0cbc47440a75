import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from bench import session
    spark = session("4")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
