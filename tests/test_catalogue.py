"""Every registered query on the smallest tables: against its SQL text, or for rows and a stable schema."""

import pytest

from catalogue import REGISTRY, training
from tests.compare import connect, difference
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    connection = connect(SMALL)
    yield connection
    connection.close()


@pytest.fixture(autouse=True)
def small_models(monkeypatch):
    """The facts that model queries return hold for models of any size; small ones save minutes."""
    monkeypatch.setattr(training, "TREES", 20)
    monkeypatch.setattr(training, "BOOSTING_ROUNDS", 5)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    text, rows = difference(spark, con, SMALL, REGISTRY[name])
    assert text is None, text
    assert rows >= 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    result = entry.entry(spark)
    assert result.columns == list(REGISTRY[entry.FLAGSHIP].columns)
    assert set(entry.oracle_sql()) <= set(entry.queries())
