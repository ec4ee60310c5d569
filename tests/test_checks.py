"""Every registered query against its SQL, over the smallest scale folder."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import check  # noqa: E402
import __spark_entry__  # noqa: E402, F401
from quirelens.plans.registry import CHECKS, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con(sf_dir):
    return check.connect(sf_dir)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, sf_dir, key):
    outcome = check.compare(spark, con, key, sf_dir)
    assert outcome.startswith(("ok", "rows")), outcome


def test_every_query_has_sql():
    assert set(QUERIES) == set(CHECKS)
