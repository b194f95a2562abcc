"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in
DataFrame functions only.

Targets: sources in code point order, null last, weigh ``WEIGHTS`` repeating and share
``FACTOR`` times all words; a target stops at ``CAP`` times its source's words, and the
excess goes to the others by weight until none is above.

Blocks: a source with n documents is dealt by hash into about sqrt(n) blocks of about
sqrt(n) documents (fewer and larger ones while these would hold under ``BLOCK_DOCS``).  A target's whole multiples of the source draw every block; the rest
draws blocks in a permuted order, without the documents longer than it, until the next would
exceed it, and of that block single documents, in hash order, that still fit.  While need is
left, the later blocks are drawn in the same way for it, without the documents that are longer
than what is left.  So a source's words miss its target by less than its smallest document left
out, over all blocks, and no document is drawn more than ``CAP`` times.

Tree: the exact numbers of blocks to draw per source are split between the left and right
half of the output shards by multivariate-hypergeometric draws, and so on down to single
shards; each shard then takes its own disjoint stretch of every source's block sequence and
is shuffled locally by hash.  All draws are hashes of ids and ``seed``: re-runs agree.

Null texts have size 0; a null source is a source of its own; documents of size 0 are drawn
with their block.  Rows equal in id and text are drawn or left together.  An empty table
gives an empty mix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.llm.common import fresh, let, row_key, stored, table, words

WEIGHTS = (5.0, 2.0, 1.0)
FACTOR = 1.5
CAP = 2.0
BLOCK_DOCS = 256
#: Words per output shard.
SHARD_WORDS = 4_000_000
SEED = 20_240_601
#: Tables of sources or blocks up to so many rows are broadcast, larger ones are shuffled.
BROADCAST_ROWS = 50_000


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _uniform(*of: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*of), 11) * F.lit(2.0 ** -53)


def _steps(first: Column, last: Column) -> Column:
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))


def hypergeometric(good: Column, bad: Column, n: Column, u: Column) -> Column:
    """How many of ``n`` draws without replacement from ``good + bad`` are good, by inversion
    of the uniform ``u``: probabilities relative to the mode's, summed up to 12 standard
    deviations off on either side (the tails left out weigh under 1e-30)."""
    def draw(p: Column) -> Column:
        def up(k: Column) -> Column:
            return (p["good"] - k) * (p["n"] - k) / ((k + 1) * (p["bad"] - p["n"] + k + 1))

        def down(k: Column) -> Column:
            return k * (p["bad"] - p["n"] + k) / ((p["good"] - k + 1) * (p["n"] - k + 1))

        def total(ks: Column, ratio) -> Column:
            zero = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("t"))
            return F.aggregate(ks, zero, lambda a, k: F.struct(
                (a["w"] * ratio(k)).alias("w"), (a["t"] + a["w"] * ratio(k)).alias("t")))["t"]

        def find(ks: Column, ratio, start: Column, x: Column, by: int) -> Column:
            zero = F.struct(F.lit(1.0).alias("w"), start.alias("t"), p["mode"].alias("k"))
            return F.aggregate(ks, zero, lambda a, k: F.when(a["t"] > x, a).otherwise(F.struct(
                (a["w"] * ratio(k)).alias("w"), (a["t"] + a["w"] * ratio(k)).alias("t"), (k + by).alias("k"))))["k"]

        def pick(s: Column) -> Column:
            x = u * (1.0 + s["up"] + s["down"])
            return F.when(x < 1.0 + s["up"], find(s["ups"], up, F.lit(1.0), x, 1)).otherwise(
                find(s["downs"], down, F.lit(0.0), x - 1.0 - s["up"], -1))
        ups = _steps(p["mode"], p["top"] - 1)
        downs = F.reverse(_steps(p["bottom"] + 1, p["mode"]))
        return let(F.struct(ups.alias("ups"), downs.alias("downs")), lambda s: let(
            F.struct(s["ups"], s["downs"], total(s["ups"], up).alias("up"), total(s["downs"], down).alias("down")), pick))

    g, b, m = good.cast("double"), bad.cast("double"), n.cast("double")
    all_ = F.greatest(g + b, F.lit(1.0))
    sd = F.sqrt(m * g / all_ * b / all_ * (all_ - m) / F.greatest(all_ - 1, F.lit(1.0)))
    lo, hi = F.greatest(n - bad, F.lit(0).cast("long")), F.least(n, good)
    reach = F.ceil(sd * 12).cast("long") + 12
    mode = F.greatest(lo, F.least(hi, F.floor((m + 1) * (g + 1) / (all_ + 2)).cast("long")))
    return let(F.struct(g.alias("good"), b.alias("bad"), m.alias("n"), mode.alias("mode"),
                        F.least(hi, mode + reach).alias("top"), F.greatest(lo, mode - reach).alias("bottom")), draw)


def sources(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, factor: float = FACTOR,
            cap: float = CAP) -> DataFrame:
    """One row per source: k (its place), source, n, words (long), target (double)."""
    stats = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    every = stats.agg(F.sort_array(F.collect_list(F.struct(
        F.col("source").isNull().alias("none"), "source", "n", "words"))).alias("s"))
    w = F.array(*(F.lit(float(x)) for x in weights))

    def with_ratio(s: Column) -> Column:
        weighed = F.transform(s, lambda x, i: F.struct(
            (x["words"] * cap / F.get(w, i % len(weights))).alias("ratio"), i.alias("k"), x["source"].alias("source"),
            x["n"].alias("n"), x["words"].alias("words"), F.get(w, i % len(weights)).alias("w")))
        return let(weighed, solve)

    def solve(s: Column) -> Column:
        goal = F.aggregate(s, F.lit(0.0), lambda a, x: a + x["words"]) * factor
        zero = F.struct(goal.alias("goal"), F.aggregate(s, F.lit(0.0), lambda a, x: a + x["w"]).alias("w"),
                        F.lit(False).alias("done"))
        level = F.aggregate(F.sort_array(s), zero, lambda a, x: F.when(
            ~a["done"] & (x["ratio"] * a["w"] < a["goal"]), F.struct(
                (a["goal"] - x["words"] * cap).alias("goal"), (a["w"] - x["w"]).alias("w"), F.lit(False).alias("done")),
        ).otherwise(F.struct(a["goal"], a["w"], F.lit(True).alias("done"))))
        return let(level, lambda v: F.transform(s, lambda x: F.struct(
            x["k"], x["source"], x["n"], x["words"],
            F.when(x["ratio"] * v["w"] < v["goal"], x["words"] * cap)
            .otherwise(F.when(v["w"] > 0, x["w"] * v["goal"] / v["w"]).otherwise(x["words"] * cap)).alias("target"))))

    return every.select(F.explode(let(F.col("s"), with_ratio)).alias("s")).select("s.*")


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(k, shard, first, count): per source and shard, the stretch of the source's block
    sequence that the shard draws.  ``quotas`` has one row per source: k, blocks."""
    nodes = (quotas.agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "blocks"))), lambda x: x["blocks"]).alias("q"))
             .select(F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("m"), "q"))
    for level in range(max(0, math.ceil(math.log2(shards)))):
        if level and level % 6 == 0:
            nodes = nodes.repartition("lo")
        left_m = F.floor(F.col("m") / 2).cast("long")
        all_ = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x)
        zero = F.struct(all_.alias("left"), F.floor(all_ * left_m / F.col("m")).cast("long").alias("n"),
                        F.array().cast("array<bigint>").alias("out"))

        def take(a: Column, q: Column) -> Column:
            u = _uniform(F.lit(seed), F.col("lo"), F.col("m"), F.size(a["out"]))
            return let(hypergeometric(q, a["left"] - q, a["n"], u), lambda got: F.struct(
                (a["left"] - q).alias("left"), (a["n"] - got).alias("n"), F.array_append(a["out"], got).alias("out")))
        halves = nodes.select("lo", "m", "q", F.aggregate("q", zero, take)["out"].alias("got"))
        nodes = halves.select(F.explode(F.when(F.col("m") == 1, F.array(F.struct("lo", "m", "q"))).otherwise(F.array(
            F.struct("lo", left_m.alias("m"), F.col("got").alias("q")),
            F.struct((F.col("lo") + left_m).alias("lo"), (F.col("m") - left_m).alias("m"),
                     F.zip_with("q", "got", lambda x, y: x - y).alias("q"))))).alias("s")).select("s.*")
    cells = nodes.select(F.col("lo").alias("shard"), F.posexplode("q").alias("k", "count")).filter("count > 0")
    upto = F.sum("count").over(Window.partitionBy("k").orderBy("shard"))
    return cells.select("k", "shard", (upto - F.col("count")).alias("first"), "count")


def _draw_rest(dealt: DataFrame, blocks: DataFrame, needs: DataFrame, n_sources: int, n_blocks: int, seed: int) -> DataFrame:
    """(k, block, limit, keys): the blocks drawn for the rest of the sources' targets, of each
    the documents of at most ``limit`` words and, where ``keys`` is there, only those.
    ``needs`` has (k, need, after): the rest, and the place after which blocks are free."""
    spark = dealt.sparkSession
    upto = F.sum("block_words").over(Window.partitionBy("k").orderBy("place"))
    drawn = None
    while True:
        # the blocks that are free, without the documents that no longer fit
        free = blocks.select("k", "block", "place").join(_small(needs, n_sources), "k").filter("need > 0 and place > after")
        fit = dealt.select("k", "block", "row_key", "size", "all").join(_small(free, n_blocks), ["k", "block"]).filter(
            F.col("all") <= F.col("need"))
        taken = fit.groupBy("k", "block", "place", "need").agg(F.sum("size").alias("block_words")).withColumn("upto", upto)
        before = F.col("upto") - F.col("block_words")
        taken = stored(spark, taken.select("k", "block", "place", "need", "upto", (F.col("need") - before).alias("left"))
                       .filter("left > 0"), "mix-taken")
        # of the block that exceeds the need: the documents that still fit, in hash order
        last = _small(taken.filter("upto > need").select("k", "block", "left"), n_sources)
        some = (fit.join(last, ["k", "block"]).groupBy("k", "block", "left", "row_key")
                .agg(F.sum("size").alias("size")).groupBy("k", "block", "left")
                .agg(F.sort_array(F.collect_list(F.struct(F.xxhash64("row_key", F.lit(seed + 2)).alias("h"), "size", "row_key"))).alias("ds")))
        fits = F.aggregate("ds", F.struct(F.col("left").alias("left"), F.array().cast("array<bigint>").alias("keys")),
                           lambda a, x: F.when(x["size"] <= a["left"], F.struct(
                               (a["left"] - x["size"]).alias("left"), F.array_append(a["keys"], x["row_key"]).alias("keys"))).otherwise(a))
        some = some.select("k", "block", fits.alias("f")).select("k", "block", "f.keys", F.col("f.left").alias("rest"))
        now = stored(spark, taken.join(_small(some, n_sources), ["k", "block"], "left").select(
            "k", "block", "place", F.col("need").alias("limit"), "keys", "rest"), "mix-drawn")
        drawn = now if drawn is None else drawn.unionByName(now)
        needs = now.filter("keys is not null").select("k", F.col("rest").alias("need"), F.col("place").alias("after"))
        if needs.filter("need >= 1").isEmpty():  # nothing exceeded, or no need is left
            return drawn.select("k", "block", "limit", "keys")


def plan(docs: DataFrame, seed: int = SEED, shard_words: int = SHARD_WORDS, **targets) -> DataFrame:
    """(row_key, doc_id, size, source_size, target, draws), one row per row of ``docs``:
    draws is an array of the (epoch, shard) in which the document goes to the mix."""
    spark = docs.sparkSession
    sizes = stored(spark, docs.select(
        row_key(F.col("doc_id"), F.col("text")).alias("row_key"), "doc_id", "source",
        F.size(words(F.col("text"))).cast("long").alias("size")), "mix-sizes")
    by_source = stored(spark, sources(sizes, **targets), "mix-sources")
    n_sources, goal = by_source.agg(F.count("*"), F.sum("target")).first()
    shards = max(1, math.ceil((goal or 0) / shard_words))
    of = _small(by_source.withColumn("n_blocks", F.greatest(F.lit(1), F.least(
        F.ceil(F.sqrt("n")), F.floor(F.col("n") / BLOCK_DOCS))).cast("long")), n_sources)
    dealt = sizes.join(of.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left").withColumn(
        "block", F.pmod(F.xxhash64("row_key", F.lit(seed)), "n_blocks")).drop("of")
    # rows equal in id and text fit together or not at all
    again = dealt.groupBy("k", "row_key").agg(F.count("*").alias("copies"), F.sum("size").alias("all")).filter("copies > 1").drop("copies")
    dealt = stored(spark, dealt.join(again, ["k", "row_key"], "left").withColumn("all", F.coalesce("all", "size")), "mix-dealt")
    # blocks in permuted order, and which are drawn how often
    order = Window.partitionBy("k").orderBy(F.xxhash64("block", F.lit(seed + 1)), "block")
    whole = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0).cast("long")
    blocks = stored(spark, dealt.groupBy("k", "block").agg(F.first("words").alias("words"), F.first("target").alias("target"))
                    .withColumn("place", F.row_number().over(order) - 1)
                    .withColumn("n", F.count("*").over(Window.partitionBy("k")))
                    .withColumn("whole", whole), "mix-blocks")
    n_blocks = blocks.count()
    needs = blocks.groupBy("k").agg(F.first(F.col("target") - F.col("whole") * F.col("words")).alias("need")).select(
        "k", "need", F.lit(-1).alias("after"))
    partly = _draw_rest(dealt, blocks, needs, n_sources, n_blocks, seed)
    # block sequence: epoch by epoch, in permuted order; the tree deals it to the shards
    fully = blocks.filter("whole > 0").select(
        "k", "block", "n", "place", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).alias("epoch")).select(
        "k", "block", "epoch", (F.col("epoch") * F.col("n") + F.col("place")).alias("at"),
        F.lit(None).cast("double").alias("limit"), F.lit(None).cast("array<bigint>").alias("keys"))
    nth = F.row_number().over(Window.partitionBy("k").orderBy("place")) - 1
    sequence = fully.unionByName(partly.join(blocks.select("k", "block", "whole", "n", "place"), ["k", "block"]).select(
        "k", "block", F.col("whole").alias("epoch"), (F.col("whole") * F.col("n") + nth).alias("at"), "limit", "keys"))
    quotas = by_source.select("k").join(sequence.groupBy("k").agg(F.count("*").alias("blocks")), "k", "left").select(
        "k", F.coalesce("blocks", F.lit(0)).cast("long").alias("blocks"))
    stretches = split_quotas(quotas, shards, seed).select(
        "k", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1)).alias("at"))
    draws = (sequence.join(stretches, ["k", "at"])
             .groupBy("k", "block").agg(F.sort_array(F.collect_list(F.struct("epoch", "shard", "limit", "keys"))).alias("draws")))
    mine = F.filter("draws", lambda d: (d["limit"].isNull() | (F.col("all") <= d["limit"]))
                    & (d["keys"].isNull() | F.array_contains(d["keys"], F.col("row_key"))))
    return dealt.join(_small(draws, n_blocks), ["k", "block"], "left").select(
        "row_key", "doc_id", "size", F.col("words").alias("source_size"), "target",
        F.coalesce(F.transform(mine, lambda d: F.struct(d["epoch"].alias("epoch"), d["shard"].alias("shard"))),
                   F.array().cast("array<struct<epoch:bigint,shard:bigint>>")).alias("draws"))


def mix(docs: DataFrame, seed: int = SEED, shard_words: int = SHARD_WORDS, **targets) -> DataFrame:
    """The mixed documents: all columns of ``docs``, a row for each draw, and ``mix_shard``;
    rows of a shard lie together, shuffled by hash."""
    key, draw, shard = fresh(docs, "row_key", "mix_draw", "mix_shard")
    chosen = (plan(docs, seed, shard_words, **targets).filter(F.size("draws") > 0)
              .select(F.col("row_key").alias(key), F.col("draws").alias(draw)).dropDuplicates([key]))
    drawn = (docs.withColumn(key, row_key(F.col("doc_id"), F.col("text"))).join(chosen, key)
             .withColumn(draw, F.explode(draw)).withColumn(shard, F.col(draw)["shard"]))
    return (drawn.repartition(shard)
            .sortWithinPartitions(shard, F.xxhash64(F.lit(seed), key, F.col(draw)["epoch"]))
            .select(*docs.columns, shard))


def mixed_documents(docs: DataFrame) -> DataFrame:
    return mix(docs).select(*docs.columns)


def op2_source_mixing(spark, sf_dir):
    return plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"))
