import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from learnlake.session import local_session

    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        "tests", 4, **{"spark.checkpoint.dir": str(shared), "spark.sql.warehouse.dir": str(shared / "warehouse")}
    )
    yield session
    session.stop()


@pytest.fixture
def docs(spark):
    """JSON-like values -> frame with ``payload`` and ``doc``."""
    import json

    from pyspark.sql import functions as F

    def build(*values):
        rows = [(i, v if isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "n long, payload string").withColumn("doc", F.try_parse_json("payload"))

    return build


def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
