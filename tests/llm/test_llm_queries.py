"""Registered queries against their SQL twins."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from compare import connect, differences  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from tidelog.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    found = contract.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(found)
    assert [sum(n.startswith(f"op{k}_") for n in found) for k in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    assert differences(spark, connect(SF), SF, queries.QUERIES[name], queries.ORACLES[name]) == []
