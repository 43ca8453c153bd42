import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from smogmesh.llm.common import ship  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)
