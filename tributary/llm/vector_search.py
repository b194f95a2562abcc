"""Approximate nearest neighbours by learned partitions.

Fitting, on a sample of at most ``SAMPLE`` vectors (least hashes of the id): the sample's
exact neighbour graph is cut into balanced parts by recursive bisection, and a small neural
classifier learns from each vector the share of its neighbours in every part.  Every vector
of the table is then stored in its ``STORED`` most probable parts, and a query is routed to
its ``PROBES`` most probable parts, however many vectors there are (to more only where those
hold too few candidates), and ranked there by the exact inner product in double precision.
The number of probes bounds the cost; the recall it gives depends on the data.

Parts next to each other in the bisection form slices of ``SLICE`` parts.  A task holds a
slice and merges what a query finds in all of the slice's parts, so that at most k rows a
query and slice leave it.  Slices are cut into blocks of bounded size on either side, so one
with a third of all vectors is many tasks.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do null
ids.  An inner product needs equal lengths: vectors are searched among those of their length
(over ``MAX_LENGTHS`` different lengths are an error).  A query's own rows are those with its
id; a query repeated with the same vector counts once; candidates repeated are candidates
each.  Ties go to the smaller id.  Few or no vectors give fewer or no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.llm.common import stored, table

K = 20
SAMPLE = 4096
GRAPH_K = 48
#: Tables of fewer vectors are one part; larger ones have ``LEAST_PARTS`` or, so that a part
#: has about ``PART_ROWS`` vectors, up to ``MAX_PARTS`` (a sample must fill them).
SMALL = 1024
LEAST_PARTS = 64
MAX_PARTS = 128
PART_ROWS = 1000
PROBES = 28
STORED = 2
SLICE = 8
HIDDEN = 128
EPOCHS = 60
#: Components of the candidates and of the queries in one task.
BLOCK_VALUES = 1 << 22
QUERY_BLOCK_VALUES = 1 << 18
MAX_LENGTHS = 16


def usable(vector: Column) -> Column:
    """Neither null nor zero, all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


# -- fitting on the sample -----------------------------------------------------------------
def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Ids of the k largest inner products of each vector with the others."""
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 512):
        s = x[at:at + 512] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at:at + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def _bisect(a: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Two halves of equal size of a graph (weights ``a``) with few edges between them."""
    n = len(a)
    root = np.sqrt(np.maximum(a.sum(axis=1), 1e-9))
    flat = root / np.linalg.norm(root)
    v = rng.standard_normal(n).astype(a.dtype)
    for _ in range(40):  # second eigenvector of the normalised graph
        v -= flat * (flat @ v)
        v = 0.5 * (v + (a @ (v / root)) / root)
        v /= np.linalg.norm(v) + 1e-30
    side = np.zeros(n, bool)
    side[np.argsort(v / root, kind="stable")[n // 2:]] = True
    for _ in range(10):  # swap pairs while that saves edges
        pull = a @ np.where(side, 1.0, -1.0)
        gain = np.where(side, -pull, pull)
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left = left[np.argsort(-gain[left], kind="stable")]
        right = right[np.argsort(-gain[right], kind="stable")]
        m = min(len(left), len(right), max(1, n // 50))
        ok = gain[left[:m]] + gain[right[:m]] > 0
        if not ok.any():
            break
        side[left[:m][ok]], side[right[:m][ok]] = True, False
    return side


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """A part for each vertex, all of near equal size; ``parts`` is a power of two."""
    n = len(graph)
    a = np.zeros((n, n), np.float32)
    a[np.repeat(np.arange(n), graph.shape[1]), graph.ravel()] = 1
    a = a + a.T
    out, rng = np.zeros(n, np.int64), np.random.default_rng(seed)

    def split(ids: np.ndarray, first: int, m: int) -> None:
        if m == 1 or len(ids) < 2:
            out[ids] = first
            return
        side = _bisect(a[np.ix_(ids, ids)], rng)
        split(ids[~side], first, m // 2)
        split(ids[side], first + m // 2, m // 2)
    split(np.arange(n), 0, parts)
    return out


class Router:
    """One hidden layer and a softmax over the parts."""

    def __init__(self, x: np.ndarray, share: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std() + 1e-9
        d, parts = x.shape[1], share.shape[1]
        self.w = [rng.standard_normal((d, HIDDEN)) * math.sqrt(2 / d), np.zeros(HIDDEN),
                  rng.standard_normal((HIDDEN, parts)) * math.sqrt(1 / HIDDEN), np.zeros(parts)]
        self.w = [w.astype(np.float32) for w in self.w]
        z, m, v, step = ((x - self.mean) / self.scale).astype(np.float32), [0] * 4, [0] * 4, 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(z))
            for at in range(0, len(z), 128):
                ids = order[at:at + 128]
                h = np.maximum(z[ids] @ self.w[0] + self.w[1], 0)
                out = self._softmax(h @ self.w[2] + self.w[3])
                g = (out - share[ids]) / len(ids)
                back = (g @ self.w[2].T) * (h > 0)
                step += 1
                rate = 3e-3 * 0.5 * (1 + math.cos(math.pi * epoch / EPOCHS)) * math.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                for i, grad in enumerate((z[ids].T @ back, back.sum(0), h.T @ g, g.sum(0))):
                    m[i] = 0.9 * m[i] + 0.1 * grad
                    v[i] = 0.999 * v[i] + 0.001 * grad * grad
                    self.w[i] = (self.w[i] - rate * m[i] / (np.sqrt(v[i]) + 1e-8)).astype(np.float32)

    @staticmethod
    def _softmax(x: np.ndarray) -> np.ndarray:
        x = np.exp(x - x.max(axis=1, keepdims=True))
        return x / x.sum(axis=1, keepdims=True)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale).astype(np.float32)
        return self._softmax(np.maximum(z @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3])


def fit(vectors: DataFrame, n: int) -> Router | None:
    """The router, or None when one part is enough.  ``vectors``: vec_id, vec."""
    if n < SMALL:
        return None
    parts = min(MAX_PARTS, max(LEAST_PARTS, 1 << max(0, round(math.log2(n / PART_ROWS)))))
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec").collect()
    x = np.array([r[0] for r in rows], np.float32)
    k = min(GRAPH_K, len(x) - 1)
    graph = neighbour_graph(x, k)
    part = balanced_parts(graph, parts)
    share = np.zeros((len(x), parts), np.float32)
    np.add.at(share, (np.repeat(np.arange(len(x)), k), part[graph].ravel()), 1 / (k + 1))
    share[np.arange(len(x)), part] += 1 / (k + 1)
    return Router(x.astype(np.float64), share)


# -- routing and search ----------------------------------------------------------------------
def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _route(router: Router | None):
    """The parts of each vector, most probable first: all of a query's, ``STORED`` of others."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(2))
            p = router.probabilities(x) if router else np.ones((len(x), 1))
            order = np.argsort(-p, axis=1, kind="stable").astype(np.int32)
            asked = [o.tolist() if q else None for o, q in zip(order, b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(order[:, :STORED].tolist(), pa.list_(pa.int32())),
                 pa.array(asked, pa.list_(pa.int32()))], names=["vec_id", "row", "vec", "parts", "asked"])
    return run


def _probes(held: dict[int, int], probes: int, enough: int):
    """The first ``probes`` parts of each query, or more until they hold ``enough`` vectors."""
    def run(batches):
        for b in batches:
            first = []
            for order in b.column(3).to_pylist():
                in_them = np.cumsum([held.get(p, 0) for p in order])
                first.append(order[:max(probes, int(np.searchsorted(in_them, enough)) + 1)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(first, pa.list_(pa.int32()))],
                                             names=["vec_id", "vec", "key", "parts"])
    return run


def _rank(k: int):
    """What the queries of a group find in it: in each part the candidates stored there meet
    the queries routed there; a candidate of several parts is one column."""
    def members(parts: pa.ChunkedArray, rows: np.ndarray) -> dict[int, np.ndarray]:
        parts = parts.combine_chunks().take(pa.array(rows))
        row = np.repeat(np.arange(len(rows)), parts.value_lengths().to_numpy())
        part = parts.flatten().to_numpy()
        order = np.argsort(part, kind="stable")
        values, at = np.unique(part[order], return_index=True)
        return dict(zip(values.tolist(), np.split(row[order], at[1:])))

    def run(t: pa.Table) -> pa.Table:
        is_query = t.column("is_query").to_numpy()
        ids, x, key, row = (t.column("vec_id").to_numpy(), _matrix(t.column("vec")), t.column("key").to_numpy(),
                            t.column("row").to_numpy())
        low = t.column("slice")[0].as_py() * SLICE
        cand, queries = np.flatnonzero(~is_query), np.flatnonzero(is_query)
        cand = cand[np.lexsort((row[cand], ids[cand]))]
        c, c_ids, c_rows = x[cand], ids[cand], row[cand]
        stored_in, asked_in = members(t.column("parts"), cand), members(t.column("parts"), queries)
        shared = [p for p in range(low, low + SLICE) if p in stored_in and p in asked_in]
        rows, step = [], max(1, min(256, (1 << 23) // max(1, len(cand))))
        for at in range(0, len(queries), step):
            q = queries[at:at + step]
            s = np.full((len(q), len(cand)), -np.inf)
            for p in shared:
                here = asked_in[p]
                here = here[(here >= at) & (here < at + step)] - at
                if len(here):
                    s[np.ix_(here, stored_in[p])] = x[q[here]] @ c[stored_in[p]].T
            s[ids[q][:, None] == c_ids[None, :]] = -np.inf
            kth = -np.partition(-s, k - 1, axis=1)[:, k - 1] if s.shape[1] > k else np.full(len(q), -np.inf)
            for i, asked in enumerate(q):
                slack = 1e-9 * max(1.0, abs(kth[i])) if np.isfinite(kth[i]) else 0.0
                near = np.flatnonzero((s[i] >= kth[i] - slack) & (s[i] > -np.inf))
                score = (c[near] * x[asked]).sum(axis=1)  # summed alike for equal vectors: ties stay ties
                top = np.argsort(-score, kind="stable")[:k]
                rows.append((np.full(len(top), ids[asked]), np.full(len(top), key[asked]), c_ids[near[top]],
                             c_rows[near[top]], score[top]))
        types = [pa.int64()] * 4 + [pa.float64()]
        cols = [np.concatenate(z) for z in zip(*rows)] if rows else [[]] * 5
        return pa.table([pa.array(z, ty) for z, ty in zip(cols, types)],
                        names=["query_id", "key", "vec_id", "row", "score"])
    return run


def route(rows: DataFrame, n: int) -> DataFrame:
    """(vec_id, row, vec, parts, asked), written: where each vector is stored and, of the
    queries, all parts in their order.  ``rows``: vec_id, vec, is_query."""
    # ``row`` names a row from here on: it is written with it
    named = rows.select("vec_id", F.monotonically_increasing_id().alias("row"), "vec", "is_query")
    return stored(rows.sparkSession, named.mapInArrow(
        _route(fit(rows, n)), "vec_id long, row long, vec array<double>, parts array<int>, asked array<int>"), "routed-vectors")


def _found(rows: DataFrame, d: int, n: int, k: int, probes: int) -> DataFrame:
    """(query_id, key, vec_id, row, score) of the vectors of one length."""
    routed = route(rows, n)
    held = {r["part"]: r["count"] for r in routed.select(F.explode("parts").alias("part")).groupBy("part").count().collect()}
    asked = (routed.filter("asked is not null").withColumn("key", F.xxhash64("vec")).dropDuplicates(["vec_id", "key"])
             .select("vec_id", "vec", "key", "asked")
             .mapInArrow(_probes(held, probes, STORED * (k + 1)), "vec_id long, vec array<double>, key long, parts array<int>"))
    slices = F.explode(F.array_distinct(F.transform("parts", lambda p: F.floor(p / SLICE).cast("int")))).alias("slice")
    stored_in = routed.select("vec_id", "row", "vec", "parts", slices)
    asked_in = asked.select("vec_id", "vec", "key", "parts", slices)
    # one row per slice on either side: bounded by MAX_PARTS / SLICE
    blocks = (stored_in.groupBy("slice").agg(F.ceil(F.count("*") * d / BLOCK_VALUES).cast("int").alias("c"))
              .join(asked_in.groupBy("slice").agg(F.ceil(F.count("*") * d / QUERY_BLOCK_VALUES).cast("int").alias("q")), "slice"))
    both = ["vec_id", "row", "vec", "key", "is_query", "parts", "slice", "cb", "qb"]
    stored_in = stored_in.join(F.broadcast(blocks), "slice").select(
        "vec_id", "row", "vec", F.lit(0).cast("long").alias("key"), F.lit(False).alias("is_query"), "parts", "slice",
        F.pmod(F.xxhash64("row"), "c").cast("int").alias("cb"),
        F.explode(F.sequence(F.lit(0), F.col("q") - 1)).alias("qb")).select(*both)
    asked_in = asked_in.join(F.broadcast(blocks), "slice").select(
        "vec_id", F.lit(0).cast("long").alias("row"), "vec", "key", F.lit(True).alias("is_query"), "parts", "slice",
        F.explode(F.sequence(F.lit(0), F.col("c") - 1)).alias("cb"),
        F.pmod(F.xxhash64("vec_id", "key"), "q").cast("int").alias("qb")).select(*both)
    return stored_in.unionByName(asked_in).groupBy("slice", "cb", "qb").applyInArrow(
        _rank(k), "query_id long, key long, vec_id long, row long, score double")


def search(table_: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", vector: str = "embedding",
           probes: int = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query."""
    rows = table_.filter(F.col(vec_id).isNotNull() & usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"))
    lengths = rows.groupBy(F.size("vec").alias("d")).count().orderBy("d").limit(MAX_LENGTHS + 1).collect()
    if len(lengths) > MAX_LENGTHS:
        raise ValueError(f"vectors of over {MAX_LENGTHS} lengths")
    parts = [_found(rows.filter(F.size("vec") == r["d"]), r["d"], r["count"], k, probes) for r in lengths]
    if not parts:
        return table_.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    # a candidate stored in two slices may be found in both; one shuffle serves both steps
    once = found.repartition("query_id", "key").dropDuplicates(["query_id", "key", "vec_id", "row"])
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id", "row")
    return (once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op4_vector_search(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, F.col("vec_id") % 20 == 0)
