import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="tessera-tests")
    yield s


@pytest.fixture(scope="module", autouse=True)
def small_grid(request):
    """test_model_queries runs its model queries over four points of the grid, as it runs them with few rounds and folds;
    tests/test_query_grid.py holds the registered grid."""
    if request.module.__name__.rpartition(".")[2] != "test_model_queries":
        yield
        return
    from tessera.plans import queries as Q

    production, Q.QUERY_GRID = Q.QUERY_GRID, {"eta": [0.15, 0.3], "max_depth": [2, 4]}
    yield
    Q.QUERY_GRID = production
