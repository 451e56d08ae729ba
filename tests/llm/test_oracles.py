"""The SQL of the corpus queries against their rows."""

from __future__ import annotations

import pytest

from compare import compare
from llm_cases import SF
from logtrail.llm.queries import ORACLES


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, name):
    assert compare(spark, SF, name) == ""
