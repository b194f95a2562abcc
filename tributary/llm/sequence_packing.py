"""Packing token sequences by non-negative least squares on the length histogram.

A document's ids end with ``END``.  It is cut into full windows and a remainder; lengths are
rounded up to units of ``UNIT`` tokens.  All combinations of at most ``DEPTH`` lengths that
fill a window are enumerated, and their repeat counts solved against the histogram of
lengths by non-negative least squares, then rounded down to what is there.  The residual
histogram is packed greedily, longest first; what would still leave gaps, or fill a window with
more than ``MOST`` pieces, is laid end to end by its true length and cut at the window's edge.  The histogram and the plan are bounded by the number of lengths,
whatever the data: the plan gives each length ranges of ranks, and every piece finds its
sequence by its rank among pieces of its length (counted per task, then summed, so one
frequent length is no hot group).

Null or empty texts are the single id ``END``.  Repeated rows are packed each by itself.
An empty table gives no pieces.  Padding: a sequence by plan is padded by less than a unit for
each of its at most ``MOST`` pieces and ``SLACK`` units, a laid one not at all, but for the last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.llm.common import table
from tributary.llm.tokens import worker_encoder
from tributary.session import scratch_path

WINDOW = 2048
UNIT = 16
DEPTH = 3
END = 1
#: A greedy sequence may leave so many units open.
SLACK = 2
#: Pieces of a greedy sequence at most: each may waste the rest of a unit.
MOST = 6


# -- plan on the histogram -----------------------------------------------------------------
def combinations(full: int, depth: int) -> list[tuple[int, ...]]:
    """Non-increasing tuples of at most ``depth`` lengths that sum to ``full``."""
    def grow(left: int, most: int, depth: int) -> Iterator[tuple[int, ...]]:
        if left == 0:
            yield ()
        elif depth:
            for x in range(min(left, most), 0, -1):
                if x * depth < left:
                    break
                for rest in grow(left - x, x, depth - 1):
                    yield (x, *rest)
    return list(grow(full, full, depth))


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the active-set method on the normal equations."""
    ata, atb = a.T @ a, a.T @ b
    x = np.zeros(a.shape[1])
    free = np.zeros(a.shape[1], bool)
    tol = 1e-9 * max(float(np.abs(atb).max(initial=0)), 1e-30)
    for _ in range(6 * a.shape[0]):
        slope = atb - ata @ x
        slope[free] = -np.inf
        j = int(slope.argmax())
        if slope[j] <= tol:
            break
        free[j] = True
        while True:
            ids = np.flatnonzero(free)
            s = np.linalg.lstsq(ata[np.ix_(ids, ids)], atb[ids], rcond=None)[0]
            if (s > 0).all():
                x[:] = 0
                x[ids] = s
                break
            down = s <= 0
            step = x[ids][down] / np.maximum(x[ids][down] - s[down], 1e-300)
            x[ids] += step.min() * (s - x[ids])
            drop = ids[(x[ids] <= 1e-12 * max(float(x.max()), 1e-30)) & down]
            x[drop] = 0
            free[drop] = False
            if not free.any():
                break
    return x


def plan_windows(histogram: dict[int, int], full: int = WINDOW // UNIT, depth: int = DEPTH):
    """(per length its ranges of ranks (from, to, sequence, slot), per length the rank of its
    first piece that is laid, number of sequences by plan)."""
    left = np.zeros(full + 1, np.int64)
    for k, v in histogram.items():
        left[k] = v
    used = np.zeros(full + 1, np.int64)
    ranges: dict[int, list[tuple[int, int, int, int]]] = {k: [] for k in histogram}
    sequences = 0

    def place(pattern: tuple[int, ...], repeats: int) -> None:
        nonlocal sequences
        for slot, length in enumerate(pattern):
            ranges[length].append((int(used[length]), int(used[length]) + repeats, sequences, slot))
            used[length] += repeats
            left[length] -= repeats
        sequences += repeats

    def fits(pattern: tuple[int, ...]) -> int:
        return min(int(left[k]) // pattern.count(k) for k in set(pattern))

    combos = [c for c in combinations(full, depth) if all(k in histogram for k in c)]
    if combos:
        a = np.zeros((full, len(combos)))
        for j, c in enumerate(combos):
            for k in c:
                a[k - 1, j] += 1
        x = nnls(a, left[1:].astype(float))
        for j in np.argsort(-x, kind="stable"):
            if (n := min(int(x[j] + 1e-6), fits(combos[j]))) > 0:
                place(combos[j], n)
    while left.any():
        top = int(np.flatnonzero(left).max())
        pattern, space, avail = [top], full - top, left.copy()
        avail[top] -= 1
        while (more := np.flatnonzero(avail[:space + 1])).size:
            k = int(more.max())
            pattern.append(k)
            avail[k] -= 1
            space -= k
        if space <= SLACK and len(pattern) <= MOST:
            place(tuple(pattern), fits(tuple(pattern)))
        else:
            left[top] = 0
    return ranges, {k: int(used[k]) for k in histogram}, sequences


# -- pieces ----------------------------------------------------------------------------------
def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
           unit: int = UNIT, tokenizer: str | None = None) -> DataFrame:
    """(task, units, place, tokens, doc_id, start, length, doc_tokens, ids): ids little-endian
    unsigned 32-bit; place and tokens count the pieces of equal units before in the task, and
    their ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        task = TaskContext.get().partitionId()
        counts: dict[int, tuple[int, int]] = {}
        out: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.append(encoder.ids(t.as_py()), np.uint32(END)).astype("<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start:start + window]
                    units = -(-len(piece) // unit)
                    place, tokens = counts.get(units, (0, 0))
                    counts[units] = place + 1, tokens + len(piece)
                    out.append((task, units, place, tokens, i, start, len(piece), len(ids), piece.tobytes()))
                    size += len(piece)
                    if size > 1 << 21:
                        yield batch()
                        out, size = [], 0
        if out:
            yield batch()
    names = ["task", "units", "place", "tokens", "doc_id", "start", "length", "doc_tokens", "ids"]
    types = [pa.int32(), pa.int32(), *[pa.int64()] * 6, pa.binary()]
    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(
        run, "task int, units int, place long, tokens long, doc_id long, start long, length long, doc_tokens long, ids binary")


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids, sequence_id, offset), one row per piece."""
    spark = docs.sparkSession
    path = scratch_path(spark, "pieces")
    # written once: ranks within a task must not be counted again in another order
    cut = pieces(docs, doc_id, text, tokenizer=tokenizer)
    cut.write.option("compression", "zstd").parquet(path)
    cut = spark.read.schema(cut.schema).parquet(path)
    per_task = cut.groupBy("units", "task").agg(F.count("*").alias("n"), F.sum("length").alias("t"))
    tasks = Window.partitionBy("units").orderBy("task")
    before = per_task.select("units", "task", *((F.sum(c).over(tasks) - F.col(c)).alias(f"{c}_before") for c in "nt"))
    totals = {r["units"]: r for r in per_task.groupBy("units").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).collect()}
    ranges, planned, sequences = plan_windows({u: r["n"] for u, r in totals.items()})
    ranked = cut.join(before, ["units", "task"]).withColumn("rank", F.col("place") + F.col("n_before")).withColumn(
        "tokens", F.col("tokens") + F.col("t_before"))
    # a few ranges per length and pattern: bounded by the lengths, not by the data
    found = spark.createDataFrame([(u, ranges[u], planned[u]) for u in totals],
                                  "units int, ranges array<struct<lo:long,hi:long,seq:long,slot:long>>, laid_rank long")
    ranked = ranked.join(F.broadcast(found), "units")
    in_plan = {u: t for u, t in ranked.filter("rank < laid_rank").groupBy("units").agg(F.sum("length")).collect()}
    starts, at = [], 0
    for u in sorted(totals, reverse=True):  # laid pieces of a length follow those of the next longer one
        starts.append((u, at - in_plan.get(u, 0)))
        at += totals[u]["t"] - in_plan.get(u, 0)
    ranked = ranked.join(F.broadcast(spark.createDataFrame(starts, "units int, laid_at long")), "units")
    mine = F.get(F.filter("ranges", lambda r: (r["lo"] <= F.col("rank")) & (F.col("rank") < r["hi"])), 0)
    at = F.col("laid_at") + F.col("tokens")
    room = WINDOW - at % WINDOW
    line = F.lit(sequences) + F.floor(at / WINDOW).cast("long")

    def part(skip, length, seq, slot):
        return F.struct(skip.cast("long").alias("skip"), length.cast("long").alias("length"),
                        seq.cast("long").alias("sequence_id"), slot.cast("long").alias("slot"))
    whole = F.array(part(F.lit(0), F.col("length"), mine["seq"] + F.col("rank") - mine["lo"], mine["slot"]))
    laid = F.when(room >= F.col("length"), F.array(part(F.lit(0), F.col("length"), line, at % WINDOW))).otherwise(F.array(
        part(F.lit(0), room, line, at % WINDOW), part(room, F.col("length") - room, line + 1, F.lit(0))))
    placed = ranked.select("doc_id", "start", "doc_tokens", "ids",
                           F.explode(F.when(F.col("rank") < F.col("laid_rank"), whole).otherwise(laid)).alias("p"))
    placed = placed.select(
        "doc_id", (F.col("start") + F.col("p.skip")).alias("start"), "p.length", "doc_tokens",
        F.substring("ids", (F.col("p.skip") * 4 + 1).cast("int"), (F.col("p.length") * 4).cast("int")).alias("ids"),
        "p.sequence_id", "p.slot")
    return placed


def with_offsets(placed: DataFrame) -> DataFrame:
    """``offset`` of each piece: the lengths before it in its sequence (a few rows each)."""
    upto = F.sum("length").over(Window.partitionBy("sequence_id").orderBy("slot"))
    return placed.withColumn("offset", upto - F.col("length")).drop("slot")


def packed_documents(docs: DataFrame) -> DataFrame:
    """The pieces with their place and a checksum of their ids."""
    return with_offsets(pack(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op3_sequence_packing(spark, sf_dir):
    return packed_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
