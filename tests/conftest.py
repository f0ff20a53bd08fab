from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers look modules up on their own path: saved pipelines and UDFs need the package there.
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

from marram.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def flowers(spark):
    """A keyed table in the shape of the flower data: 3 classes that the measurements tell apart."""
    rows = []
    for i in range(150):
        c = i % 3
        wobble = (i * 7919 % 100) / 100.0
        rows.append((i, 4.5 + c + wobble, 3.0 + wobble / 2, 1.4 + 1.8 * c + wobble / 3, 0.2 + 0.8 * c + wobble / 4,
                     ("setosa", "versicolor", "virginica")[c]))
    return spark.createDataFrame(
        rows, "row_key long, `sepal length (cm)` double, `sepal width (cm)` double, "
              "`petal length (cm)` double, `petal width (cm)` double, species string")
