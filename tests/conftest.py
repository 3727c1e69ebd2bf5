import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from kinship.session import local_session

    session = local_session("*", shuffle_partitions=8, app="kinship-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny(spark):
    from tiny_data import SCHEMA, TINY_TARGETS, TINY_TRAIN

    return spark.createDataFrame(TINY_TRAIN, SCHEMA), spark.createDataFrame(TINY_TARGETS, SCHEMA)
