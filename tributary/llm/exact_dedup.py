"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Every row is written once, with the SHA-256 of its normalised text, into blocks (a run of
   rows of one input partition, at most ``BLOCK_ROWS``); the table is bucketed by block, so
   what comes back to a block finds its rows without moving them.
2. A block sorts its distinct fingerprints (the leading bits of the SHA-256: ``SPARE_BITS``
   more than the row count needs) and sends each owner, a range of fingerprints, its share as
   Golomb-coded gaps: some 14 bits a row and not the text.  A text that a block holds a
   thousand times is sent once.
3. An owner decodes its lists, finds the fingerprints that several blocks sent, and answers
   each of those blocks with a bitmap over its list.
4. Rows that the bitmap or their own block marks are suspects (all copies, and one in
   2^SPARE_BITS others).  They alone are shuffled: grouped by SHA-256 and normalised text, so
   that texts are equal byte by byte and not by their hash.  Copies fold before the shuffle.

An owner's lists are bounded by the number of owners, which grows with the rows; fingerprints
spread evenly over owners, and a hot text costs one entry a block.

Equal: identical after deleting every character of ``[\\x20\\x09-\\x0D]``; a null text counts as
empty, so null, empty and blank texts are copies of each other.  Of equal texts the row with
the most code points in its original text stays, then that with the smallest doc_id (null
last), then any one of rows equal in both: exactly one row of each group.  Rows that repeat
are rows of their own.  An empty table gives an empty result.  Other columns pass through;
those named like a result column are left out of the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import BLANKS, fresh, stored_in_buckets, stored, table

#: Rows of a block: bounds what one task holds of narrow rows.
BLOCK_ROWS = 1 << 18
#: Fingerprints of an owner, about: bounds what one task decodes.
OWNER_ROWS = 1 << 21
#: Bits of a fingerprint beyond log2(rows): one row in 2^SPARE_BITS is a suspect by chance.
SPARE_BITS = 12

RESULT = ["keep_id", "group_size", "kept", "text_sha256"]


def normalised(text: Column) -> Column:
    """``text`` without its white space; empty for null."""
    out = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


# -- Golomb code of sorted numbers ---------------------------------------------------------
def encode(values: np.ndarray, shift: int) -> tuple[bytes, bytes]:
    """Sorted distinct numbers as gaps: quotients by 2^shift in unary, remainders in shift bits."""
    gaps = np.diff(values, prepend=np.int64(0))
    quotients = gaps >> shift
    unary = np.zeros(int(quotients.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    rest = (gaps[:, None] >> np.arange(shift - 1, -1, -1)) & 1
    return np.packbits(unary).tobytes(), np.packbits(rest.astype(np.uint8).ravel()).tobytes()


def decode(n: int, shift: int, unary: bytes, rest: bytes) -> np.ndarray:
    stops = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    quotients = np.diff(stops, prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(rest, np.uint8), count=n * shift).reshape(n, shift).astype(np.int64)
    remainders = bits @ (np.int64(1) << np.arange(shift - 1, -1, -1, dtype=np.int64))
    return np.cumsum((quotients << shift) + remainders)


def divisor_shift(n: int, width: int) -> int:
    """The power of two nearest below ln 2 times the mean gap of ``n`` numbers under 2^width."""
    return max(0, math.floor(math.log2(math.log(2) * 2 ** width / n))) if n else 0


def _fingerprints(sha: pa.Array, bits: int) -> np.ndarray:
    head = np.frombuffer(b"".join(s[:8] for s in sha.to_pylist()), ">u8").astype(np.uint64)
    return (head >> np.uint64(64 - bits)).astype(np.int64)


# -- the exchange ----------------------------------------------------------------------------
def _blocks(docs: DataFrame, text: str, names: list[str]) -> DataFrame:
    """``docs`` with (block, place, sha, chars): rows of one block lie in one file."""
    block, place, sha, chars = names
    row, run, bits = F.monotonically_increasing_id(), BLOCK_ROWS, 33
    return docs.select(
        "*",
        (F.shiftright(row, bits) * F.lit((1 << bits) // run) + F.floor(row.bitwiseAND((1 << bits) - 1) / run)).cast("long").alias(block),
        (row % run).cast("int").alias(place),
        F.unhex(F.sha2(normalised(F.col(text)), 256)).alias(sha),
        F.coalesce(F.length(text), F.lit(0)).alias(chars))


def _send(bits: int, owner_bits: int):
    """A block's messages: (owner, block, n, shift, unary, rest)."""
    width = bits - owner_bits
    schema = "owner long, block long, n int, shift int, unary binary, rest binary"

    def run(rows: pa.Table) -> pa.Table:
        fps = np.unique(_fingerprints(rows.column("sha"), bits))
        owners = fps >> width
        cuts = np.flatnonzero(np.diff(owners, prepend=-1))
        block, out = rows.column("block")[0].as_py(), []
        for a, b in zip(cuts, [*cuts[1:], len(fps)]):
            shift = divisor_shift(int(b - a), width)
            unary, rest = encode(fps[a:b] & ((1 << width) - 1), shift)
            out.append((int(owners[a]), block, int(b - a), shift, unary, rest))
        return pa.table(list(map(list, zip(*out))), schema=pa.schema(
            [("owner", pa.int64()), ("block", pa.int64()), ("n", pa.int32()), ("shift", pa.int32()),
             ("unary", pa.binary()), ("rest", pa.binary())]))
    return run, schema


def _answer(messages: pa.Table) -> pa.Table:
    """An owner's answers: for each block that sent a fingerprint others sent too, a bitmap."""
    lists = [decode(*m) for m in zip(*(messages.column(c).to_pylist() for c in ("n", "shift", "unary", "rest")))]
    values, counts = np.unique(np.concatenate(lists), return_counts=True)
    shared = values[counts > 1]
    owner, out = messages.column("owner")[0].as_py(), []
    for block, fps in zip(messages.column("block").to_pylist(), lists):
        at = np.searchsorted(shared, fps)
        hit = (at < len(shared)) & (shared[np.minimum(at, len(shared) - 1)] == fps) if len(shared) else np.zeros(0, bool)
        if hit.any():
            out.append((block, owner, np.packbits(hit).tobytes()))
    schema = pa.schema([("block", pa.int64()), ("owner", pa.int64()), ("bitmap", pa.binary())])
    return pa.table(list(map(list, zip(*out))) or [[], [], []], schema=schema)


def _mark(bits: int, owner_bits: int):
    """A block's suspects, as one bitmap over its places in 64-bit words."""
    width = bits - owner_bits
    schema = "marked long, words array<long>"

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        kind = pa.schema([("marked", pa.int64()), ("words", pa.list_(pa.int64()))])
        if not rows.num_rows:
            return pa.table([[], []], schema=kind)
        fps, back, counts = np.unique(_fingerprints(rows.column("sha"), bits), return_inverse=True, return_counts=True)
        hit = counts > 1
        starts = np.searchsorted(fps >> width, np.arange((1 << owner_bits) + 1))
        for owner, bitmap in zip(answers.column("owner").to_pylist(), answers.column("bitmap").to_pylist()):
            a, b = starts[owner], starts[owner + 1]
            hit[a:b] |= np.unpackbits(np.frombuffer(bitmap, np.uint8), count=b - a).astype(bool)
        places = rows.column("place").to_numpy()[hit[back]]
        if not len(places):
            return pa.table([[], []], schema=kind)
        words = np.zeros(BLOCK_ROWS // 64, np.uint64)
        np.bitwise_or.at(words, places >> 6, np.uint64(1) << (places & 63).astype(np.uint64))
        used = words[:int(places.max() >> 6) + 1].view(np.int64)
        return pa.table([[rows.column("block")[0].as_py()], [used]], schema=kind)
    return run, schema


def with_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with keep_id, group_size, kept and text_sha256."""
    spark = docs.sparkSession
    docs = docs.drop(*(c for c in docs.columns if c.lower() in RESULT and c not in (doc_id, text)))
    block, place, sha, chars, body, bitmap = names = fresh(docs, "block", "place", "sha", "chars", "body", "bitmap")
    rows = stored_in_buckets(spark, _blocks(docs, text, names[:4]), "dedup-rows", block)
    total = rows.count()
    bits = min(62, max(1, total).bit_length() + SPARE_BITS)
    owner_bits = max(0, math.ceil(math.log2(max(1, total) / OWNER_ROWS)))
    narrow = rows.select(F.col(block).alias("block"), F.col(place).alias("place"), F.col(sha).alias("sha"))

    messages = narrow.groupBy("block").applyInArrow(*_send(bits, owner_bits))
    answers = messages.groupBy("owner").applyInArrow(_answer, "block long, owner long, bitmap binary")
    marks = stored(spark, narrow.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(*_mark(bits, owner_bits)),
                   "dedup-suspects").select(F.col("marked").alias(block), F.col("words").alias(bitmap))

    held = rows.join(marks, block, "left")
    at = F.col(place)
    suspect = F.coalesce(F.getbit(F.get(bitmap, F.shiftright(at, 6)), at.bitwiseAND(63)), F.lit(0)) == 1
    # Larger is better: code points, then the smaller id (null last), in one number.
    least, span, step = (F.expr(f"{n}BD") for n in (-(1 << 63), 1 << 64, 1 << 65))
    place_of_id = F.coalesce(F.col(doc_id).cast("decimal(20,0)") - least, span)
    order = (F.col(chars).cast("decimal(10,0)") * step - place_of_id).cast("decimal(38,0)")
    row = (F.col(block) * F.lit(BLOCK_ROWS) + F.col(place)).alias("row")
    groups = (rows.join(marks, block).filter(suspect)
              .select(sha, normalised(F.col(text)).alias(body), order.alias("order"), row, F.col(doc_id).alias("id"))
              .groupBy(sha, body).agg(F.count(F.lit(1)).alias("size"), F.max_by("row", "order").alias("first_row"),
                                      F.max_by("id", "order").alias("first_id")))
    # Two texts of one SHA-256 have never been seen; if they are, nothing is merged in silence.
    one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("two texts of one SHA-256")).cast("long"))
    groups = stored(spark, groups.groupBy(sha).agg(F.coalesce(one, F.max("size")).alias("size"), F.max("first_row").alias("first_row"),
                                                   F.max("first_id").alias("first_id")).filter("size > 1"), "dedup-groups")

    # A row that is no suspect has no group and needs no shuffle; nor does it meet a hot key.
    keep = [c for c in docs.columns]
    hashed = F.lower(F.hex(sha)).alias("text_sha256")
    single = held.filter(~suspect).select(
        *keep, F.col(doc_id).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), hashed)
    found = held.filter(suspect).join(groups, sha, "left")
    alone = F.col("size").isNull()
    return single.unionByName(found.select(
        *keep, F.when(alone, F.col(doc_id)).otherwise(F.col("first_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("first_row") == row)).alias("kept"), hashed))


def kept_documents(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with the columns of ``docs``."""
    flag, = fresh(docs, "kept")
    renamed = docs.withColumnsRenamed({c: f"{c}′" for c in docs.columns if c.lower() in RESULT})
    return (with_duplicates(renamed).withColumnRenamed("kept", flag).filter(flag).select(*renamed.columns).toDF(*docs.columns))


def op13_exact_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


#: keep_id of a group whose ids are all null is null.
SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body
  FROM documents),
r AS (
  SELECT doc_id, body, count(*) OVER (PARTITION BY body) AS group_size,
    first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS n
  FROM d WINDOW w AS (PARTITION BY body ORDER BY chars DESC, doc_id NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT doc_id, keep_id, group_size, n = 1 AS kept, sha256(body) AS text_sha256 FROM r"""
