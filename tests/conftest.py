import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from bazaar.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set SQL settings for one test."""
    before = {}

    def change(**settings):
        for name, value in settings.items():
            name = name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
