import pytest

from tests.llm.fixtures import write_tables


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """A folder of small awkward tables, read by the registered queries."""
    return write_tables(spark, str(tmp_path_factory.mktemp("tables")))


@pytest.fixture(scope="session")
def empty_tables(spark, tmp_path_factory):
    return write_tables(spark, str(tmp_path_factory.mktemp("empty")), empty=True)
