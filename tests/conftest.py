import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from docweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", spark__checkpoint__dir=str(tmp_path_factory.mktemp("stage")), spark__sql__shuffle__partitions=4, spark__ui__enabled="false",
        spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Collected rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(str(x) for x in r))


def plan(df):
    return df._jdf.queryExecution().toString()


def formatted_plan(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out
