"""SimHash near-duplicates, found by the generalised pigeonhole principle.

Fingerprint: 64 bits, each set if it is set in over half of the XXH64 (seed 42) hashes of a
text's word shingles.  Fingerprints are linked at ``MAX_BITS`` or fewer differing bits.

The 64 bits are grouped into parts, correlated bits together.  A part may differ by its own
threshold t (-1: the part is not probed); when the sum of t + 1 exceeds ``MAX_BITS`` no link
can be lost.  The thresholds are allotted by dynamic programming on the candidate counts and
probe counts estimated from a bounded sample of fingerprints (the sample decides the cost
only, never the result).  Each distinct fingerprint is stored under its value in a part and
looks up the values within t bits of it; candidates are verified by their bit distance.
Crowded values are split again by the same principle over the bits left, so no group's pairs
are enumerated, and each group gives back a spanning forest, not all its links.

Null and empty texts have the fingerprint zero and are linked like any other.  Copies share
one fingerprint row, so repeated rows cost nothing in the search.  A null doc_id is never a
component's least id unless all its ids are null (then component_id is null).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import fresh, row_key, stored, table
from tributary.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Numbers of parts among which the dynamic programme chooses.
PARTS = (1, 2, 3, 4)
#: Distinct fingerprints sampled to estimate candidates, and the cost of a verified
#: candidate relative to a probe row.
SAMPLE = 4096
PAIR_COST = 0.05
#: Values with more fingerprints than this are split again before they meet in one task.
CROWDED = 50_000
#: Groups up to this size are compared directly.
DIRECT = 1024


# -- fingerprints ------------------------------------------------------------------------
def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    if n <= 1:
        return h(b" ".join(words), SEED)
    total = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for a very long text
        part = [h(b" ".join(words[i:i + shingle]), SEED) for i in range(at, min(n, at + (1 << 16)))]
        total += np.unpackbits(np.array(part, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n).view(">u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(row_key, doc_id, fp): fp as a signed long, one row per row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp, pa.int64())],
                                             names=["row_key", "doc_id", "fp"])
    narrow = docs.select(row_key(F.col(doc_id), F.col(text)).alias("row_key"),
                         F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, "row_key long, doc_id long, fp long")


# -- parts and thresholds ----------------------------------------------------------------
def _bit_sums(fps: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints and how many have bits i and j both set (64 x 64)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((64, 64), np.int64)
        n = 0
        for b in batches:
            bits = _bits(b.column(0).to_numpy(zero_copy_only=False)).astype(np.float32)
            both += (bits.T @ bits).astype(np.int64)
            n += len(bits)
        flat = np.append(both.ravel(), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat, pa.int64())],
                                         names=["k", "v"])
    rows = fps.select("fp").mapInArrow(run, "k int, v long").groupBy("k").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(64 * 64 + 1, np.int64)
    for k, v in rows:
        flat[k] = v
    return int(flat[-1]), flat[:-1].reshape(64, 64)


def _bits(fp: np.ndarray) -> np.ndarray:
    """Column i: bit i, counted from the lowest."""
    return np.unpackbits(fp.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Parts of near equal size; each starts with the free bit of highest total correlation
    and takes the free bits most correlated with what it has."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, out = set(range(64)), []
    for k in range(parts, 0, -1):
        size = len(free) // k
        ids = sorted(free)
        part = [max(ids, key=lambda i: (corr[i, ids].sum(), -i))]
        free -= {part[0]}
        while len(part) < size:
            nxt = max(sorted(free), key=lambda i: (corr[i, part].mean(), -i))
            part.append(nxt)
            free.discard(nxt)
        out.append(sorted(part))
    return out


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def allot(sample: np.ndarray, n: int, parts: list[list[int]], max_bits: int) -> tuple[float, list[int]]:
    """Least estimated cost and each part's threshold, by dynamic programming over the parts."""
    s = len(sample)
    scale = (n / max(s, 1)) ** 2
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for bits in parts:
        near = np.zeros(max_bits + 2)
        if s > 1:
            kept = sample & np.uint64(_mask(bits))
            for at in range(0, s, 256):
                d = np.bitwise_count(kept[at:at + 256, None] ^ kept[None, :])
                near[:max_bits + 1] += np.bincount(d.ravel(), minlength=65)[:max_bits + 1]
            near[0] -= s
        probes, cost = 0.0, [0.0]
        for t in range(max_bits + 1):
            probes += float(np.prod([(len(bits) - i) / (i + 1) for i in range(t)]))
            cost.append(n * (probes + (t > 0)) + PAIR_COST * scale * near[:t + 1].sum() / 2)
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (c, ts) in best.items():
            for t in range(-1, max_bits + 1):
                if t >= 0 and t > len(bits):
                    continue
                k = min(used + t + 1, max_bits + 1)
                if k not in step or c + cost[t + 1] < step[k][0]:
                    step[k] = (c + cost[t + 1], [*ts, t])
        best = step
    return best[max_bits + 1]


def plan_parts(fps: DataFrame, max_bits: int = MAX_BITS) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the cheapest partition; unprobed parts are left out."""
    n, both = _bit_sums(fps)
    if n < 2:
        return [(list(range(64)), 0)]
    rows = fps.orderBy(F.xxhash64("fp")).limit(SAMPLE).collect()
    sample = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    choices = []
    for m in PARTS:
        parts = group_bits(n, both, m)
        cost, ts = allot(sample, n, parts, max_bits)
        choices.append((cost, [(b, t) for b, t in zip(parts, ts) if t >= 0]))
    return min(choices, key=lambda c: c[0])[1]


# -- probing and verifying ---------------------------------------------------------------
def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _flips(bits: list[int], t: int) -> list[int]:
    out, now = [], [(0, -1)]
    for _ in range(t):
        now = [(m | 1 << b, i) for m, last in now for i, b in enumerate(bits) if i > last]
        out += [m for m, _ in now]
    return out


def _entries(part: int, own: Column, flips: Column) -> Column:
    """A stored entry (no bit flipped) and the probes of one part."""
    return F.transform(flips, lambda m, i: F.struct(
        F.lit(part).cast("byte").alias("part"), own.bitwiseXOR(m).alias("value"), (i > 0).alias("probe")))


def _split(bits: list[int], max_bits: int) -> list[list[int]]:
    return [x.tolist() for x in np.array_split(np.array(bits), max_bits + 1)]


def _forest(fp: np.ndarray, probe: np.ndarray, free: list[int], max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is linked in one group: fingerprints stored there, and probes."""
    if len(fp) > DIRECT and len(free) > max_bits:
        for bits in _split(free, max_bits):
            value = fp & np.uint64(_mask(bits))
            order = np.argsort(value, kind="stable")
            cuts = np.flatnonzero(np.diff(value[order])) + 1
            rest = [b for b in free if b not in bits]
            for ids in np.split(order, cuts):
                if len(ids) > 1 and not probe[ids].all():
                    yield from _forest(fp[ids], probe[ids], rest, max_bits)
        return
    label = np.arange(len(fp))
    while True:
        before = label.copy()
        for at in range(0, len(fp), 512):
            d = np.bitwise_count(fp[at:at + 512, None] ^ fp[None, :]) <= max_bits
            d &= ~(probe[at:at + 512, None] & probe[None, :])
            d[np.arange(len(d)), np.arange(at, at + len(d))] = True
            label[at:at + 512] = np.where(d, label[None, :], len(fp)).min(axis=1)
        label = label[label]
        if (label == before).all():
            break
    ids = np.flatnonzero(label != np.arange(len(fp)))
    yield fp[ids], fp[label[ids]]


def _verify(free_of: dict[int, list[int]], max_bits: int):
    def links(keys: list[np.ndarray], fp: np.ndarray, probe: np.ndarray) -> Iterator[pa.RecordBatch]:
        same = np.ones(max(len(fp) - 1, 0), bool)
        for k in keys:
            same &= k[1:] == k[:-1]
        starts = np.flatnonzero(np.append(True, ~same)) if len(fp) else np.array([], int)
        sizes = np.diff(np.append(starts, len(fp)))
        group = np.repeat(np.arange(len(starts)), sizes)
        big = sizes > 64
        left, right = [], []
        small = ~big[group] if len(fp) else np.array([], bool)
        f, p, g = fp[small], probe[small], group[small]
        for step in range(1, int(sizes[~big].max(initial=0))):  # all small groups at once
            ok = (g[step:] == g[:-step]) & (np.bitwise_count(f[step:] ^ f[:-step]) <= max_bits) & ~(p[step:] & p[:-step])
            left.append(f[step:][ok])
            right.append(f[:-step][ok])
        for i in np.flatnonzero(big):
            at = slice(starts[i], starts[i] + sizes[i])
            for a, b in _forest(fp[at], probe[at], free_of[int(keys[0][starts[i]])], max_bits):
                left.append(a)
                right.append(b)
        a = np.concatenate([np.array([], np.uint64), *left]).view(np.int64)
        b = np.concatenate([np.array([], np.uint64), *right]).view(np.int64)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)[a != b], axis=0)
        for at in range(0, len(pairs), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[at:at + 50_000, k].copy(), pa.int64()) for k in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # rows of the last, unfinished key
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
            if not len(cols[0]):
                continue
            last = np.ones(len(cols[0]), bool)
            for k in cols[:4]:
                last &= k == k[-1]
            cut = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
            yield from links([c[:cut] for c in cols[:4]], cols[4][:cut].astype(np.int64).view(np.uint64), cols[5][:cut].astype(bool))
            held = [c[cut:] for c in cols]
        if held is not None:
            yield from links(held[:4], held[4].astype(np.int64).view(np.uint64), held[5].astype(bool))
    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``fps`` as all their links do."""
    plan = plan_parts(fps, max_bits)
    entries, free_of, sub = [], {}, {}
    for k, (bits, t) in enumerate(plan):
        mask = F.lit(_signed(_mask(bits)))
        own = F.col("fp").bitwiseAND(mask)
        free_of[k] = [b for b in range(64) if b not in bits] if t == 0 else list(range(64))
        sub[k] = [_signed(_mask(b)) for b in _split(free_of[k], max_bits)]
        flips = F.array(*(F.lit(_signed(m)) for m in [0, *_flips(bits, t)]))
        entries.append(_entries(k, own, flips))
    rows = fps.select("fp", F.explode(F.concat(*entries)).alias("e")).select("e.part", "e.value", "fp", "e.probe")
    counts = rows.groupBy("part", "value").agg(F.count("*").alias("n"), F.min("probe").alias("only_probes"))
    met = rows.join(counts.filter("n > 1 and not only_probes").drop("only_probes"), ["part", "value"])
    # a crowded value: by pigeonhole over the bits left, one of their subsets agrees wholly
    masks = F.element_at(F.create_map(*(x for k, v in sub.items() for x in (
        F.lit(k).cast("byte"), F.array(*(F.lit(m) for m in v))))), F.col("part"))
    again = F.when(F.col("n") <= CROWDED, F.array(F.struct(F.lit(-1).alias("i"), F.lit(0).cast("long").alias("v")))).otherwise(
        F.transform(masks, lambda m, i: F.struct(i.alias("i"), F.col("fp").bitwiseAND(m).alias("v"))))
    keyed = met.select("part", "value", "fp", "probe", F.explode(again).alias("s")).select(
        "part", "value", F.col("s.i").alias("sub"), F.col("s.v").alias("sub_value"), "fp", "probe")
    keys = ["part", "value", "sub", "sub_value"]
    return (keyed.repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(_verify(free_of, max_bits), "a long, b long").distinct())


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(row_key, doc_id, fp, root, component_id), one row per row of ``docs``: root names the
    component, component_id is its least doc_id."""
    spark = docs.sparkSession
    found = stored(spark, fingerprints(docs, doc_id, text, shingle), "fingerprints")
    distinct = stored(spark, found.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), max_bits))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    least = (rooted.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("least").alias("component_id")))
    named = rooted.join(least, "root", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
    return found.join(named, "fp").select("row_key", "doc_id", "fp", "root", "component_id")


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The row with the least doc_id of each near-duplicate group (one of them on ties)."""
    key, = fresh(docs, "row_key")
    first = (near_duplicates(docs).groupBy("root")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("m"))
             .select(F.col("m.row_key").alias(key)))
    return (docs.withColumn(key, row_key(F.col("doc_id"), F.col("text"))).join(first, key, "left_semi")
            .dropDuplicates([key]).select(*docs.columns))


def op8_simhash_dedup(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
