import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4, app="tests")


def day(text):
    return dt.date.fromisoformat(text)


def at(text):
    return dt.datetime.fromisoformat(text)


def rows(df, *columns):
    """Rows as sorted tuples."""
    shown = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in shown.collect()), key=str)
