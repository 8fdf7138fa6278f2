from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bedside.operators.slices import SLICE_ROWS  # noqa: E402
from bedside.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build("8", 4)
    yield session
    session.stop()


@pytest.fixture(params=["whole", "sliced"])
def either(request, spark):
    """Run a test on whole series and again with every series cut into slices."""
    if request.param == "sliced":
        spark.conf.set(SLICE_ROWS, "3")
    yield spark
    spark.conf.unset(SLICE_ROWS)
