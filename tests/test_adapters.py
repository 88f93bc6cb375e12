"""The Spark adapter views equal their DuckDB mirror row for row."""
import pytest

from chartwise.sources import BASE_TABLES, Sources
from oracle import adapters as OA

from .conftest import SF_SMALL
from .helpers import table_rows


@pytest.mark.parametrize("name", BASE_TABLES)
def test_adapter_matches_duckdb(spark, duck, name):
    src = Sources.from_events(spark, SF_SMALL, materialize=False)
    sdf = src[name].toPandas()
    ddf = duck.execute(OA.prefix() + f" SELECT * FROM {name}").df()
    assert table_rows(sdf) == table_rows(ddf)
    assert len(sdf) > 0
