"""The queries against their SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
from compare import difference  # noqa: E402

from quire.llm import oracle, queries  # noqa: E402


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_matches_oracle(spark, sf, name):
    assert difference(queries.queries()[name](spark, sf), sf, oracle.oracle_sql()[name]) == ""


def test_names():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 11)]
