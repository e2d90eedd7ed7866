import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from jobloom.session import local_session

    return local_session(8)


@pytest.fixture()
def rows():
    """Sorted plain tuples of a DataFrame."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
