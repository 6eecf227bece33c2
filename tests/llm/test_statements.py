"""Queries against their DuckDB statements."""

import pytest

pytest.importorskip("touchline.llm")

from compare import compare, connect  # noqa: E402
from conftest import SF_DIR  # noqa: E402

from touchline.llm.queries import QUERIES, SQL  # noqa: E402


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, name):
    message, n = compare(spark, connect(SF_DIR), QUERIES[name], SQL[name], SF_DIR)
    assert message is None and n > 0


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
