import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from meterloom.session import local_session, shared_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", "tests", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    shared_folder(session)
    yield session
    session.stop()


@pytest.fixture
def rows():
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)
    return collect
