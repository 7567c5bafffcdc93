import pytest

from tests.llm import tables


@pytest.fixture(scope="session")
def awkward(tmp_path_factory):
    return tables.folder(tmp_path_factory)


@pytest.fixture(scope="session")
def empty(tmp_path_factory):
    return tables.empty_folder(tmp_path_factory)
