from __future__ import annotations

import pytest

from shopsight.llm import workers


@pytest.fixture(scope="session", autouse=True)
def _importable(spark):
    workers.importable(spark)
