"""Shared Spark session for the tests: local mode, 8 shuffle partitions."""

from __future__ import annotations

import os
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if REPO not in sys.path:
    sys.path.insert(0, REPO)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from appmart.session import build_session
    session = build_session("local[*]", shuffle_partitions=8, app_name="appmart-tests")
    yield session


@pytest.fixture
def scratch(spark, tmp_path):
    """A fresh folder for one test's files."""
    return str(tmp_path)
