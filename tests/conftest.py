from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from parvis.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "local[8]", app="tests", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def rows(df, *order):
    """Collected rows as tuples, for small results."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple(str(x) for x in r)) if not order else out
