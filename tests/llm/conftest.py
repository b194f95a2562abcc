import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Quality string, row_key string"
PROSE = "One plain sentence of many ordinary words stands here number {} and goes on for a while until it ends."


@pytest.fixture(scope="session")
def docs(spark):
    """Null texts and ids, empty and very long texts, ties, repeated rows, clashing columns."""
    same = "\n".join(PROSE.format(i) for i in range(12))
    rows = [(1, same, "en", "a", 1, "x", "y"), (1, same, "en", "a", 1, "x", "y"), (2, same, "en", None, 1, "x", "y"),
            (3, None, None, "b", None, None, None), (4, "", "en", "b", 0, "x", "y"), (5, " \n\t ", "en", None, 3, "x", "y"),
            (None, same + "\nTail of no one else at all, which is new.", "en", "a", 1, "x", "y"), (6, "word", "en", "c", 4, "x", "y"),
            (7, "\n".join(PROSE.format(1000 + i % 3000) for i in range(4000)), "en", "c", 1, "x", "y"),
            (8, "!!! ??? 12", "en", "c", 1, "x", "y"), (9, "Released under the MIT License. " * 300, "en", "d", 1, "x", "y")]
    rows += [(i, "\n".join(PROSE.format(i * 100 + j % 7) for j in range(i % 9)), "en", f"s{i % 4}", 1, "x", "y") for i in range(20, 60)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def spark():
    from tributary.session import get_spark
    return get_spark("tributary-tests", master="local[*]", shuffle_partitions=8, driver_memory="4g")
