import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import get_session

    session = get_session(
        master="local[*]",
        shuffle_partitions=8,
        **{
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="ll-test-ckpt-"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="ll-test-wh-"),
        },
    )
    yield session
    session.stop()


@pytest.fixture()
def workdir(spark):
    from ledgerline.session import work_dir

    return work_dir(spark, "test")
