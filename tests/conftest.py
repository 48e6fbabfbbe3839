import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from jobmart.session import build_session, ensure_checkpoint_dir

    spark = build_session(
        app_name="jobmart-tests",
        master="local[4]",
        shuffle_partitions=4,
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Tests only: a private checkpoint folder when the session names none.
    ensure_checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="jobmart-test-"))
    yield spark
    spark.stop()
