"""Every registered query equals its DuckDB oracle (sf0.001; the driver uses sf0.01)."""
import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL
from .helpers import table_rows

# the text operators have their own tests and oracles (tests/llm)
_TEXT = {name for module in E._text_modules() for name in module.QUERIES}
QUERIES = {name: fn for name, fn in E.queries().items() if name not in _TEXT}
ORACLES = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL).toPandas()
    if name not in ORACLES:
        pytest.skip("no SQL oracle (checked by unit tests)")
    ddf = duck.execute(ORACLES[name]).df()
    assert table_rows(sdf) == table_rows(ddf)


def test_every_query_has_oracle():
    missing = sorted(set(QUERIES) - set(ORACLES))
    assert missing == [], missing


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert len(df.columns) > 0
