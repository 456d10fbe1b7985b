import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskflow.session import build_session, scratch_path  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "local[4]",
        app_name="riskflow-tests",
        shuffle_partitions=4,
        extra={"spark.ui.showConsoleProgress": "false", "spark.sql.adaptive.enabled": "true"},
    )
    yield s
    s.stop()


@pytest.fixture
def work(spark, request):
    """A fresh folder under the session's checkpoint location."""
    return scratch_path(spark, request.node.name[:40].replace("[", "_").replace("]", "_"))
