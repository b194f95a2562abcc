import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sales_inputs import DECIMAL_EVENTS, DOUBLE_EVENTS  # noqa: E402
from tributary.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark("tributary-tests", master="local[*]", shuffle_partitions=8,
                        driver_memory="4g")
    yield session
    session.stop()


@pytest.fixture(params=["double", "decimal"])
def make_events(request, spark):
    from decimal import Decimal

    def make(rows):
        if request.param == "double":
            return spark.createDataFrame(rows, DOUBLE_EVENTS)
        conv = [tuple(Decimal(str(v)) if i == 3 and v is not None else v
                      for i, v in enumerate(r)) for r in rows]
        return spark.createDataFrame(conv, DECIMAL_EVENTS)
    return make
