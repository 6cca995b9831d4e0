"""The text queries against their SQL on the given tables."""

import pytest

from tallybridge.llm import registry
from tests.test_oracle import _rows, con  # noqa: F401


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_text_query_matches_sql(spark, sf, con, name):  # noqa: F811
    df = registry.QUERIES[name](spark, sf)
    result = con.execute(registry.ORACLE[name])
    want = _rows([d[0] for d in result.description], result.fetchall())
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == want
