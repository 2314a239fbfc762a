import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from subscope.session import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    s = session(
        "local[8]",
        "tests",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(base / "warehouse"),
        spark__checkpoint__dir=str(base / "shared"),
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def wh(spark):
    from subscope.plans import warehouse

    return warehouse.of(spark, SMALL)


@pytest.fixture(scope="session")
def model(wh):
    from subscope.plans.context import StarModel

    return StarModel.of(wh)


@pytest.fixture()
def rows():
    """Rows of a frame as dictionaries, sorted by their text."""

    def read(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((r.asDict() for r in df.collect()), key=lambda d: repr(list(d.values())))

    return read


@pytest.fixture()
def plan():
    """The executed physical plan as text."""

    def text(df, run=False):
        if run:
            df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    return text
