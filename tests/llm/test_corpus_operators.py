"""WARC, mixing, packing, search, SimHash and the pipeline: round trips and brute force."""

import base64
import hashlib
import zlib

import numpy as np
from pyspark.sql import functions as F

from tributary.llm import sequence_packing, simhash_dedup, source_mixing, vector_search, warc
from tributary.llm.source_mixing import _uniform, hypergeometric
from tributary.session import scratch_path


def test_warc_round_trip(spark):
    rows = [(1, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (9, None, "<p>é</p>"), (3, "http://a/ 3\r\nX: y", None),
            (4, "http://a/4", ""), (5, "http://a/5", "x" * 300_000), (6, "u", "Content-Length: 3\r\n\r\nWARC/1.1"),
            (7, "u", "same"), (7, "u", "same"), (7, "u", "same"), (None, "u", "lone"), (8, None, "two"), (8, "", "two"), (8, None, "two"),
            (None, "u", "noid"), (None, None, "noid"), (None, "u", "noid")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit("x") for c in ("sha1", "size", "n", "top", "holder", "Offset", "file")})
    index = warc.write(pages, scratch_path(spark, "warc"))
    got = warc.read(index).collect()
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    assert sorted((r["page_id"] or 0, r["payload_bytes"], r["payload_digest"]) for r in got) == sorted(
        (i or 0, len((t or "").encode()), digest(t)) for i, _, t in rows)
    assert {r["page_id"]: r["refers_to"] for r in got if r["record_type"] == "revisit"} == {
        1: 9, 2: 9, 3: 4, 7: 7, 8: 8, None: None}
    texts = {((i, u), (t or "").encode()) for i, u, t in rows}
    assert all(((r["page_id"], r["url"]), bytes(r["payload"])) in texts for r in got if r["record_type"] == "response")
    assert sum(r["record_type"] == "response" for r in got) == 8 == len({t or "" for _, _, t in rows})
    assert [r["url"] for r in got if r["page_id"] == 8 and r["record_type"] == "response"] == [""]
    some = warc.read(index.filter("page_id in (5, 6)"))
    assert {r["page_id"] for r in some.collect()} == {5, 6}
    assert warc.read(warc.write(pages.limit(0), scratch_path(spark, "warc"))).count() == 0


def test_hypergeometric_draws(spark):
    for good, bad, n in ((70, 30, 40), (3, 500, 100), (0, 5, 3), (5, 0, 3)):
        cols = [F.lit(x).cast("long") for x in (good, bad, n)]
        x = np.array([r[0] for r in spark.range(4000).select(hypergeometric(*cols, _uniform(F.lit(1), F.col("id")))).collect()])
        assert x.min() >= max(0, n - bad) and x.max() <= min(n, good)
        p, total = good / (good + bad), good + bad
        sd = (n * p * (1 - p) * (total - n) / max(total - 1, 1)) ** 0.5
        assert abs(x.mean() - n * p) <= 5 * sd / 4000 ** 0.5 + 1e-9 and abs(x.std() - sd) <= 0.1 * sd + 1e-9


def test_mix_meets_targets_and_splits_quotas(spark, docs, empty):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = source_mixing.plan(table, shard_words=50_000).join(table.select("doc_id", "source"), "doc_id").toPandas()
    plan["taken"] = plan["size"] * plan["draws"].map(len)
    by = plan.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum")).sort_index()
    cap, w, goal = 2.0 * by["size"].to_numpy(), np.array([(5, 2, 1)[i % 3] for i in range(len(by))], float), 1.5 * by["size"].sum()
    want, done = np.zeros(len(by)), np.zeros(len(by), bool)
    while True:
        want = np.where(done, cap, (goal - cap[done].sum()) * w / w[~done].sum())
        if not (want > cap + 1e-9).any():
            break
        done |= want > cap + 1e-9
    assert np.allclose(by["target"], want) and (abs(by["taken"] - by["target"]) <= 0.01 * by["target"] + 30).all()
    assert (plan["taken"] <= 2 * plan["size"]).all()
    again = source_mixing.plan(table, shard_words=50_000).toPandas()
    assert sorted(map(str, again["draws"])) == sorted(map(str, plan["draws"]))
    edge = source_mixing.plan(docs).collect()
    assert len(edge) == docs.count()
    assert len({str(r["draws"]) for r in edge if r["doc_id"] == 1}) == 1
    out = source_mixing.mix(docs)
    assert out.columns == [*docs.columns, "mix_shard"] and out.count() == sum(len(r["draws"]) for r in edge)
    assert source_mixing.mix(empty).count() == 0


def test_mix_goes_on_after_a_block_with_a_giant_document(spark):
    rng = np.random.default_rng(5)
    rows = []
    for source in range(12):
        sizes = rng.integers(3, 8, 1200).tolist()
        sizes[0] = sum(sizes) // 4
        rows += [(source * 10_000 + i, f"s{source:02}", "w " * n) for i, n in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    plan = source_mixing.plan(docs, weights=(1.0,), factor=0.5).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    assert len(plan) == len(rows)
    for _, of in plan.groupby("source"):
        drawn = of["draws"].map(len) > 0
        miss = of["target"].iloc[0] - (of["size"] * of["draws"].map(len)).sum()
        assert 0 <= miss < of["size"][~drawn].min()


def test_quotas_are_split_exactly(spark):
    quotas = spark.createDataFrame([(0, 40), (1, 0), (2, 7), (3, 100)], "k int, blocks long")
    cells = source_mixing.split_quotas(quotas, 10, 3).collect()
    per_shard, at = {}, {}
    for r in sorted(cells, key=lambda r: (r["k"], r["shard"])):
        assert r["first"] == at.get(r["k"], 0)
        at[r["k"]] = r["first"] + r["count"]
        per_shard[r["shard"]] = per_shard.get(r["shard"], 0) + r["count"]
    assert at == {0: 40, 2: 7, 3: 100} and set(per_shard.values()) <= {14, 15} and len(per_shard) == 10


def check_packed(got, rows):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((str(i), t.encode(x or "", add_special_tokens=False).ids + [1]) for i, x in rows)
    docs, sequences = {}, {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        docs.setdefault((str(r["doc_id"]), r["doc_tokens"]), []).append((r["start"], r["length"], r["ids_crc32"]))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
    assert sorted(sequences) == list(range(len(sequences)))
    for (i, n), p in docs.items():
        copies = [x for k, x in want if k == i and len(x) == n]
        assert len(copies) * n == sum(x[1] for x in p)
        for start, length, crc in p:
            assert crc in {zlib.crc32(np.array(x[start:start + length], "<u4").tobytes()) for x in copies}
    tokens = sum(len(x) for _, x in want)
    assert sum(r["length"] for r in got) == tokens
    return 1 - tokens / (2048 * max(len(sequences), 1))


def test_packing_is_exact(spark, docs, empty):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    check_packed(sequence_packing.packed_documents(docs).collect(), rows)
    odd = [(1, "two  spaces \n and\ttabs "), (2, " lead"), (3, "a <|endoftext|> in it"), (4, "  nbsp x  y")]
    check_packed(sequence_packing.packed_documents(spark.createDataFrame(odd, "doc_id long, text string")).collect(), odd)
    assert sequence_packing.packed_documents(empty).count() == 0
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert check_packed(sequence_packing.packed_documents(table).collect(), [tuple(r) for r in table.collect()]) < 0.02


def test_short_texts_are_packed_without_much_padding(spark):
    few = [(i, None if i % 2 else "word") for i in range(2048)]
    some = [(i, "one two three four five six " * (i % 9)) for i in range(3000)]
    alike = [(i, "one two three four five six seven eight " * 8) for i in range(2000)]
    for rows in (few, some, alike):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
        got = sequence_packing.packed_documents(df).collect()
        check_packed(got, rows)
        # under 5 % of padding, besides that of the last sequence
        assert 2048 * (max(r["sequence_id"] for r in got)) * 0.95 <= sum(r["length"] for r in got)


def test_window_plan_places_every_rank_once():
    rng = np.random.default_rng(3)
    for histogram in ({128: 5}, {90: 400}, {k: int(n) for k, n in zip(range(1, 129), rng.integers(1, 900, 128))}, {1: 3}, {}):
        ranges, starts, _ = sequence_packing.plan_windows(dict(histogram))
        for k, n in histogram.items():
            at = 0
            for lo, hi, _, _ in sorted(ranges[k]):
                assert lo == at and hi > lo
                at = hi
            assert at == starts[k] <= n


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 16)) * rng.uniform(0.5, 2, (3000, 1))
    x[100:1100] = x[100]  # a third of all rows are one vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(9000, None), (9020, [0.0] * 16), (9040, [float("nan")] * 16), (9060, [None] * 16), (9080, [1.0]), (9081, [2.0]), (None, [1.0] * 16), (20, x[20].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in vector_search.search(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert got.pop(9080) == [(1, 9081, 2.0)]  # among those of its length
    assert set(got) == set(range(0, 3000, 20))
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        assert all(i != q and abs(s - x[i] @ x[q]) < 1e-9 for _, i, s in found)
        s = x @ x[q]
        s[q] = -np.inf
        hits += sum(f[2] >= np.sort(s)[-20] - 1e-9 for f in found)
    assert hits >= 0.9 * 20 * len(got)
    assert len(vector_search.search(df.filter("vec_id < 3"), F.col("vec_id") == 0).collect()) == 2
    assert vector_search.search(df.limit(0), F.lit(True)).count() == 0
    clashing = df.withColumns({c: F.lit("x") for c in ("row", "key", "part", "parts", "slice", "vec", "Score", "rank")})
    assert vector_search.search(clashing, F.col("vec_id") % 20 == 0).count() == sum(map(len, got.values())) + 1


def test_search_probes_few_parts_and_finds_most(spark):
    """On the given vectors (nearly isotropic): under half of the parts are probed, rows that
    leave the group step stay in proportion to the queries, recall is over 0.9."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    n = df.count()
    assert vector_search.PROBES < vector_search.LEAST_PARTS / 2
    rows = df.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"), (F.col("vec_id") % 20 == 0).alias("is_query"))
    routed = vector_search.route(rows, n)
    assert routed.filter("size(parts) != 2 or parts[0] = parts[1]").count() == 0
    found = vector_search._found(rows, 64, n, 20, vector_search.PROBES)
    queries = df.filter("vec_id % 20 = 0").count()
    assert found.count() <= queries * 20 * vector_search.LEAST_PARTS / vector_search.SLICE
    local = df.toPandas()
    x = np.stack(local.embedding.values).astype(float)
    got = vector_search.search(df, F.col("vec_id") % 20 == 0).toPandas().groupby("query_id").vec_id.apply(set)
    hits = 0
    for i in np.flatnonzero(local.vec_id.values % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        hits += len(got[local.vec_id[i]] & set(local.vec_id.values[np.argsort(-s)[:20]]))
    assert hits >= 0.9 * 20 * queries


def brute_components(fps, bits):
    label = np.arange(len(fps))
    while True:
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= bits
        new = np.where(near, label[None, :], len(fps)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def test_links_of_crowded_parts(spark, monkeypatch):
    monkeypatch.setattr(simhash_dedup, "CROWDED", 50)
    monkeypatch.setattr(simhash_dedup, "DIRECT", 64)
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    fps = np.unique(np.concatenate([base[rng.integers(0, 30, 1500)] ^ (np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64))
                                    ^ (np.uint64(1) << rng.integers(0, 20, 1500).astype(np.uint64)), base[:15]]))
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    from tributary.llm.components import components
    root = {r["node"]: r["root"] for r in components(simhash_dedup.links(df)).collect()}
    label = brute_components(fps, 2)
    signed = fps.view(np.int64)
    mine = [root.get(int(f), int(f)) for f in signed]
    assert len({(a, b) for a, b in zip(mine, label.tolist())}) == len(set(mine)) == len(set(label.tolist()))


def test_simhash_edge_cases(docs, empty):
    got = {}
    for r in simhash_dedup.near_duplicates(docs).collect():
        got.setdefault(r["doc_id"], []).append((r["fp"], r["component_id"]))
    assert got[3] == got[4] == got[5] == [(0, 3)] and len(got[1]) == 2 and got[2][0][1] == 1
    kept = simhash_dedup.one_of_each_group(docs)
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert ids.count(1) == 1 and 2 not in ids and ids.count(3) == 1 and 4 not in ids and kept.columns == docs.columns
    assert simhash_dedup.near_duplicates(empty).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before, columns = docs.count(), docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, sf)
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == columns
        if k < 3:
            assert 0 < docs.count() <= before
            before = docs.count()
    assert docs.agg(F.sum("length")).first()[0] > 0
