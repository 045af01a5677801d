import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodestrata.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(**{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a DataFrame as sorted tuples."""

    def collect(df, *columns):
        selected = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in selected.collect()), key=str)

    return collect
