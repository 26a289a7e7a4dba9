from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def session(spark):
    from sessionmetrics.llm.shipping import ship

    ship(spark)
    return spark


@pytest.fixture(scope="session")
def edge_docs(session):
    import edge_rows

    return session.createDataFrame(edge_rows.documents(), edge_rows.SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(session):
    import edge_rows

    return session.createDataFrame([], edge_rows.SCHEMA)
