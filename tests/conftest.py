import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallygrain.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4, memory="8g")


def rows(df):
    """Rows as sorted tuples, columns in their own order."""
    return sorted([tuple(r) for r in df.collect()], key=repr)
