import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from poseval.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def corpus(spark):
    from checks.tables import CORPUS_SQL

    return spark.sql(CORPUS_SQL)
