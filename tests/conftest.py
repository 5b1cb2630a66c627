from __future__ import annotations

from uuid import uuid4

import pytest

from rankloom.session import local_session
from rankloom.sinks import Warehouse


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        "4",
        "rankloom-tests",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(folder / "warehouse"),
        spark__checkpoint__dir=str(folder / "checkpoints"),
    )
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, f"w{uuid4().hex}", str(tmp_path / "warehouse"))


@pytest.fixture
def feed_of(spark):
    """Typed feed rows from dicts; what is left out is NULL."""
    from rankloom.schemas import FEED

    def build(*rows: dict):
        return spark.createDataFrame([[row.get(n) for n in FEED.names] for row in rows], FEED)

    return build
