"""Shared helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import scratch_path

#: Words are runs of anything but ASCII white space.
BLANKS = " \t\n\x0b\x0c\r"
SPLIT = r"[\x20\x09-\x0D]+"
#: Spark's own default limit on the buckets of a table.
MAX_BUCKETS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPLIT), "")


def coded_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct, codes, upto) of texts in a task: the distinct words, each word's place among
    them in order of the texts, and how many words precede each text (the end last)."""
    found = pc.ascii_split_whitespace(texts)
    sizes = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = found.flatten().dictionary_encode()
    distinct, codes = coded.dictionary, coded.indices.to_numpy()
    if (empty := pc.index(distinct, "").as_py()) >= 0:  # white space at an end of a text
        real = codes != empty
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[real], minlength=len(sizes))
        codes = codes[real]
        codes -= codes > empty
        distinct = pa.concat_arrays([distinct[:empty], distinct[empty + 1:]])
    return distinct, codes, np.concatenate([[0], np.cumsum(sizes)])


def slices(texts: pa.Array, size: int) -> Iterator[slice]:
    """Texts in a task, some ``size`` bytes of them at once and one text at least."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + size, "right")))
        yield slice(at, end)
        at = end


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that clash with none of ``df`` (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder under the shared root and read back: its lineage
    ends there, so that a lost executor costs a re-read and not a re-computation."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_in_buckets(spark: SparkSession, df: DataFrame, name: str, key: str) -> DataFrame:
    """Like ``stored``, with the rows of each value of ``key`` in one bucket: later groupings
    and joins by ``key`` need no shuffle of these rows.  Each task writes its own rows, so
    nothing moves; rows of one key should come from one task."""
    path = scratch_path(spark, name)
    buckets = min(MAX_BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions()))
    saved = "_".join(path.rsplit("/", 1)[1].split("-"))
    df.write.option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(saved)
    return spark.table(saved)


def row_key(doc_id: Column, text: Column) -> Column:
    """Identifies a row by id and text; rows equal in both are the same document."""
    return F.xxhash64(doc_id, text, F.length(text))
