import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "tests", spark__sql__shuffle__partitions="2", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def at():
    """Time of day on the fixtures' date, in UTC."""

    def make(clock: str, day: str = "2026-07-30") -> dt.datetime:
        return dt.datetime.fromisoformat(f"{day}T{clock}+00:00")

    return make


@pytest.fixture
def money():
    return Decimal
