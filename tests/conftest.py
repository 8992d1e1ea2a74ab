import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from frameline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", spark_sql_shuffle_partitions="4", spark_ui_enabled="false",
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def same_batches(request):
    """A stage of the pipeline sets the session's Arrow batches; the next test starts with those it had."""
    yield
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
