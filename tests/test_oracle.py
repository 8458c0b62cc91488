"""Every registered query against its oracle SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from compare import difference  # noqa: E402

from quire.plans import CATALOG  # noqa: E402


@pytest.mark.parametrize("name", [n for n, q in CATALOG.items() if q.sql])
def test_matches_oracle(spark, sf, name):
    q = CATALOG[name]
    assert difference(q.run(spark, sf), sf, q.sql) == ""


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(CATALOG) <= set(entry.queries())
