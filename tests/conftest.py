import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from workload.check import connect, session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return session(4)


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture(scope="session")
def duck():
    return connect(SMALL)


@pytest.fixture(scope="session")
def policies(spark, sf_dir):
    from workload.queries import stored

    return stored(spark, sf_dir)


@pytest.fixture(scope="session")
def scored(spark, sf_dir):
    from workload import queries

    return queries.scored(spark, sf_dir)


@pytest.fixture(scope="session")
def design(spark, sf_dir):
    """(frame with targets and the sketched feature matrix, feature names), stored."""
    from ratewright.storage import materialise
    from workload.queries import full_design

    df, names = full_design(spark, sf_dir)
    return materialise(df, "design"), names
