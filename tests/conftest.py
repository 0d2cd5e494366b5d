import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from emberline.session import build_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "emberline-tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__sql__maxMetadataStringLength="100000",
        spark__sql__debug__maxToStringFields="1000",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


def rows(df, *order):
    """Rows as tuples, in the order of the given columns."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


@pytest.fixture
def as_rows():
    return rows
