import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cardflow.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, app="cardflow-tests")
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield s


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Collected rows as tuples (optionally of selected columns)."""
    if cols:
        df = df.select(*cols)
    return [tuple(r) for r in df.collect()]
