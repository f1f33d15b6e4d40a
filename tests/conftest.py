import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from nameharbor.session import prepare

    return prepare(session(partitions="4"))


@pytest.fixture
def rows(spark):
    """Rows of a frame as a sorted list of plain tuples."""

    def collect(frame, *columns):
        frame = frame.select(*columns) if columns else frame
        return sorted((tuple(r) for r in frame.collect()), key=repr)

    return collect
