import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pixelspark.session import local_session  # noqa: E402
from tests.compare import connect  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def con():
    return connect(DATA)


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def grid(spark):
    """Pixels of small arrays: ``grid({image_id: array or [channel arrays]})``."""
    def make(images, name="value", kind="double"):
        rows = []
        for image, arrays in images.items():
            arrays = arrays if np.ndim(arrays) == 3 else [arrays]
            for c, a in enumerate(arrays):
                rows += [(image, c, y, x, None if v is None or v != v else (float(v) if kind == "double" else int(v)))
                         for y, row in enumerate(a) for x, v in enumerate(row)]
        df = spark.createDataFrame(rows, f"image_id long, channel int, y int, x int, {name} {kind}")
        return df if kind == "double" else df.drop("channel")
    return make
