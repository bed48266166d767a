from __future__ import annotations

import os

import pytest

from shopstar.session import local_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session("shopstar-tests", cpus=8, partitions=4, scratch=scratch)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip(f"no tables under {SF_DIR}")
    return SF_DIR
