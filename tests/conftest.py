from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tableops.session import local_session  # noqa: E402

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, str(tmp_path_factory.mktemp("warehouse")))
    yield session
    session.stop()


@pytest.fixture
def db(spark):
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


@pytest.fixture
def sf_dir():
    return str(DATA / "sf0.001")
