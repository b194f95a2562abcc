"""How far the sources of a language differ in their use of its common terms.

The common terms of a language (in at least ``MIN_DOCS`` of its documents) are found by
iceberg prefix refinement over their UTF-8 bytes: level by level, documents are counted by
term prefix; a prefix that occurs in fewer documents than that is discarded with everything
it begins, so the next, longer level counts only extensions of prefixes that remain, and the
last pass counts complete terms.  A document's prefixes are counted once in its own task and
combined there (what a task holds is summed at ``HELD`` counts, and given on if more than
``FLUSH`` are left), so a hot term, source or language costs a row or a few a task.  The prefixes that remain go back to the
tasks as a bit filter of fixed size (``SLOTS`` bits: 2 MB whatever the input); one that
passes the filter by chance is discarded by its own count, so the result is exact.

Every (lang, source) group then has for each kept term the smoothed share
p = 1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V)), in exact decimals.  Sources are
compared over all kept terms in blocks of terms (at most ``MOST_CELLS`` term-source cells, and
``STRIPE`` sources against all others, in one group); their sums are added up by pair.

Null text, lang and source count as ''.  A group without kept terms, or a language without
any, has its pairs (value 0 if there are no kept terms) and no term rows.  Rows that repeat
are documents of their own.  Equal values rank by item in UTF-8 order.  An empty table gives
an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import coded_words, slices, stored, table

MIN_DOCS = 30
PRIOR = 5
SCALE = 1_000_000_000
TOP = 50
#: Prefix lengths in bytes, each counted in a pass of its own.
LEVELS = (6, 12)
SLOTS = 1 << 24
#: Counts that a task holds before it sums them; so many sums are then given on.
HELD = 1 << 21
FLUSH = 500_000
#: Bytes of texts of a language that are split at once.
BYTES = 1 << 23
#: Term-source cells of a block: at least so many, else as many terms as sources (a block's
#: sums by pair are then fewer than its cells), at most so many.
CELLS, MOST_CELLS = 1 << 16, 1 << 24
STRIPE = 512

#: Bytes of terms: letters and everything beyond ASCII, with A-Z lowered; others end a term.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``coded_words`` of the terms of texts without nulls, given as bytes."""
    texts = pa.concat_arrays([texts])
    _, offsets, data = texts.buffers()
    start, end = np.frombuffer(offsets, np.int32, len(texts) + 1, 4 * texts.offset)[[0, -1]]
    lowered = bytes(data[start:end] if data else b"").translate(_TERM_BYTES)
    offsets = pa.array(np.frombuffer(offsets, np.int32, len(texts) + 1, 4 * texts.offset) - start)
    return coded_words(pa.Array.from_buffers(pa.string(), len(texts), [None, offsets.buffers()[1], pa.py_buffer(lowered)]))


# -- prefix refinement -------------------------------------------------------------------------
def _numbers(lang: str, found: pa.Array, level: int | None, parents: tuple[int, bytes] | None) -> tuple[np.ndarray, pa.Array]:
    """The numbers of terms' prefixes, -1 where the shorter prefix was discarded; the prefixes."""
    found = found.cast(pa.binary())
    remain = np.ones(len(found), bool)
    if parents:
        size, bits = parents
        short = pc.binary_slice(found, 0, size).dictionary_encode()
        seed = crc32(lang.encode() + b"\0")
        slot = np.fromiter((crc32(x, seed) for x in short.dictionary.to_pylist()), np.int64, len(short.dictionary)) % SLOTS
        remain = (np.frombuffer(bits, np.uint8)[slot >> 3] >> (slot & 7) & 1).astype(bool)[short.indices.to_numpy()]
    if level is None:
        return np.where(remain, np.arange(len(found)), -1), found
    coded = pc.binary_slice(found, 0, level).dictionary_encode()
    return np.where(remain, coded.indices.to_numpy(), -1), coded.dictionary


def _tally(ids: np.ndarray, place: np.ndarray, source: np.ndarray, sources: int, width: int) -> tuple[np.ndarray, ...]:
    """(source, number, docs, n): documents and uses of each number below ``width``; ``ids`` are
    those of the documents ``place`` in order, whose sources are numbered by ``source``."""
    each = np.sort(place * width + ids)
    each = each[np.flatnonzero(np.diff(each, prepend=-1))]
    all_, once = source[place] * width + ids, source[each // max(width, 1)] * width + each % max(width, 1)
    if sources * width <= 1 << 22:
        n = np.bincount(all_, minlength=sources * width)
        key = np.flatnonzero(n)
        docs, n = np.bincount(once, minlength=sources * width)[key], n[key]
    else:
        key, n = np.unique(all_, return_counts=True)
        docs = np.unique(once, return_counts=True)[1]
    return key // max(width, 1), key % max(width, 1), docs, n


def _summed(parts: list[pa.Table]) -> pa.Table:
    """(prefix, docs, n) with each prefix once."""
    if len(parts) == 1:
        return parts[0]
    sums = pa.concat_tables(parts).group_by("prefix", use_threads=False).aggregate([("docs", "sum"), ("n", "sum")])
    return sums.select(["prefix", "docs_sum", "n_sum"]).rename_columns(["prefix", "docs", "n"])


def _counts(docs: DataFrame, level: int | None, parents, by_source: bool) -> DataFrame:
    """(lang, source, prefix, docs, n), in parts: documents with a term that begins so, and the
    uses of such terms; whole terms if ``level`` is None, '' for source unless ``by_source``."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("prefix", pa.binary()), ("docs", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = parents.value if parents else None
        parts: dict[tuple[str, str], list[pa.Table]] = defaultdict(list)
        held = 0

        def given() -> Iterator[pa.RecordBatch]:
            for key, tables in parts.items():
                sums = _summed(tables)
                same = [pa.repeat(pa.scalar(x, pa.string()), len(sums)) for x in key]
                yield from pa.table([*same, *sums.columns], schema=schema).to_batches()
            parts.clear()

        def count(lang: str, sources: list[str], source: np.ndarray, texts: pa.Array) -> None:
            """Of texts of one language, whose sources are numbered."""
            nonlocal held
            found, codes, upto = terms(texts)
            number, prefixes = _numbers(lang, found, level, before)
            ids, place = number[codes], np.repeat(np.arange(len(texts)), np.diff(upto))
            ids, place = ids[ids >= 0], place[ids >= 0]
            of, number, in_docs, n = _tally(ids, place, source, len(sources), len(prefixes))
            rows = pa.table([prefixes.take(pa.array(number)), pa.array(in_docs, pa.int64()), pa.array(n, pa.int64())], names=["prefix", "docs", "n"])
            ends = np.searchsorted(of, np.arange(len(sources) + 1))
            for k, name in enumerate(sources):
                if ends[k] < ends[k + 1]:
                    parts[lang, name].append(rows[ends[k]:ends[k + 1]])
            held += len(rows)
        for b in batches:
            lang, source = (b.column(k).dictionary_encode() for k in range(2))
            of_lang, of_source = lang.indices.to_numpy(), source.indices.to_numpy()
            order = np.argsort(of_lang, kind="stable")
            bounds = np.searchsorted(of_lang[order], np.arange(len(lang.dictionary) + 1))
            for k, name in enumerate(lang.dictionary.to_pylist()):
                own = order[bounds[k]:bounds[k + 1]]
                texts = b.column(2).take(pa.array(own))
                for at in slices(texts, BYTES):
                    used, numbered = np.unique(of_source[own[at]], return_inverse=True)
                    count(name, source.dictionary.take(pa.array(used)).to_pylist(), numbered, texts[at])
                    if held >= HELD:
                        for key, tables in parts.items():
                            parts[key] = [_summed(tables)]
                        held = sum(len(x[0]) for x in parts.values())
                        if held >= FLUSH:
                            yield from given()
                            held = 0
        yield from given()
    source = F.col("source") if by_source else F.lit("").alias("source")
    return docs.select("lang", source, F.col("text").cast("binary")).mapInArrow(run, "lang string, source string, prefix binary, docs long, n long")


def _remaining(counts: DataFrame, min_docs: int) -> bytes:
    """The bit filter over the prefixes in at least ``min_docs`` documents."""
    slot = F.crc32(F.concat(F.encode("lang", "utf-8"), F.lit(b"\0"), F.col("prefix"))) % SLOTS
    words = (counts.groupBy("lang", "prefix").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
             .select(slot.alias("slot")).groupBy(F.shiftright("slot", 5).alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("slot") % 32).cast("int"))).alias("bits")).toArrow())
    bits = np.zeros(SLOTS // 32, "<u4")
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return bits.tobytes()


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, lang_n, first): uses of each kept term in each source that has
    it and in its language; ``first`` marks one row of each (lang, term)."""
    spark = docs.sparkSession
    parents = None
    for level in LEVELS:
        bits = _remaining(_counts(docs, level, parents, False), min_docs)
        parents = spark.sparkContext.broadcast((level, bits))
    by_term = Window.partitionBy("lang", "prefix")
    # One shuffle by (lang, term) serves the sums by source and those of the language.
    counts = (_counts(docs, None, parents, True).repartition("lang", "prefix").groupBy("lang", "source", "prefix")
              .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")))
    # The order within the terms first: their sums then need no sort of their own.
    kept = (counts.withColumn("first", F.row_number().over(by_term.orderBy("source")) == 1)
            .withColumn("lang_docs", F.sum("docs").over(by_term)).withColumn("lang_n", F.sum("n").over(by_term))
            .filter(F.col("lang_docs") >= min_docs)
            .select("lang", "source", F.col("prefix").cast("string").alias("term"), "n", "lang_n", "first"))
    return stored(spark, kept, "divergence-terms")


# -- comparison ----------------------------------------------------------------------------------
def _share(count: Column, total: Column, kept: Column, prior: int, scale: int) -> Column:
    """1 + floor(scale * (count + prior) / (total + prior * kept)), exactly; null if nothing is kept."""
    wide = "decimal(20,0)"
    above = (count + prior).cast(wide) * F.expr(f"{scale}BD")
    below = (total + prior * kept).cast(wide)
    return F.when(kept > 0, F.lit(1).cast("long") + F.call_function("div", above, below))


def _compare(rows: pa.Table) -> pa.Table:
    """Sums over this block's terms of abs(p - q), for the stripe's sources against later ones."""
    made = rows.column("term").is_null().to_numpy()
    sources, terms_, p = rows.column("source").to_pylist(), rows.column("term").to_pylist(), rows.column("p").to_pylist()
    stripe, stripes = rows.column("stripe")[0].as_py(), rows.column("stripes")[0].as_py()
    names = sorted({s for s, m in zip(sources, made) if m}, key=lambda s: s.encode())
    at = {s: i for i, s in enumerate(names)}
    ids = {t: i for i, t in enumerate(dict.fromkeys(t for t in terms_ if t is not None))}
    none = np.zeros(len(names), np.int64)
    for s, v, m in zip(sources, p, made):
        if m:
            none[at[s]] = v or 0
    shares = np.repeat(none[:, None], len(ids), axis=1)
    for s, t, v, m in zip(sources, terms_, p, made):
        if not m:
            shares[at[s], ids[t]] = v
    lang, out = rows.column("lang")[0].as_py(), ([], [], [])
    for i in range(stripe, len(names), stripes):
        out[0].extend([names[i]] * (len(names) - i - 1))
        out[1].extend(names[i + 1:])
        out[2].extend(np.abs(shares[i + 1:] - shares[i]).sum(axis=1).tolist())
    return pa.table([pa.array([lang] * len(out[0]), pa.string()), pa.array(out[0], pa.string()),
                     pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], names=["lang", "a", "b", "f"])


def divergence(docs: DataFrame, *, min_docs: int = MIN_DOCS, prior: int = PRIOR, scale: int = SCALE, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has each other source of the
    language, part ``term`` the kept terms that the source uses most beyond its language."""
    spark = docs.sparkSession
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    kept = kept_terms(docs, min_docs)
    by_lang = Window.partitionBy("lang")
    used = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum(F.col("first").cast("long")).alias("firsts"))
    groups = stored(spark, docs.select("lang", "source").distinct().join(used, ["lang", "source"], "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"),
        F.coalesce(F.sum("total").over(by_lang), F.lit(0)).alias("lang_total"),
        F.coalesce(F.sum("firsts").over(by_lang), F.lit(0)).alias("v"),
        F.count(F.lit(1)).over(by_lang).alias("sources")), "divergence-groups")

    share = lambda count, total: _share(count, F.col(total), F.col("v"), prior, scale)
    full = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), "total"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    over = (full.withColumn("value", F.col("p") - share(F.col("lang_n"), "lang_total"))
            .filter("value > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top))

    cells_each = F.least(F.lit(MOST_CELLS), F.greatest(F.lit(CELLS), F.col("sources") * F.col("sources")))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("v") * F.col("sources") / cells_each)).cast("long")
    stripes = F.ceil(F.col("sources") / STRIPE).cast("long")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("stripes") - 1)).alias("stripe")
    # A row without a term declares a source, and its share of terms that it does not use.
    declared = (groups.withColumn("stripes", stripes).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
                .select("lang", "block", "source", F.lit(None).cast("string").alias("term"),
                        share(F.lit(0), "total").alias("p"), "stripes"))
    cells = full.select("lang", F.pmod(F.xxhash64("term"), blocks).alias("block"), "source", "term", "p", stripes.alias("stripes"))
    sums = (declared.unionByName(cells).select("*", each).groupBy("lang", "block", "stripe")
            .applyInArrow(_compare, "lang string, a string, b string, f long")
            .groupBy("lang", "a", "b").agg(F.sum("f").alias("value")))
    sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                              F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("side")
    pairs = (sums.select("lang", sides, "value").select("lang", "side.source", F.lit("pair").alias("part"), "side.item", "value")
             .withColumn("rank", F.row_number().over(best)))
    return pairs.unionByName(over)


def op11_source_divergence(spark, sf_dir):
    return divergence(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
  FROM documents),
t AS (
  SELECT row, lang, source, translate(term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT row, lang, source, unnest(found) AS term FROM d)),
k AS (SELECT lang, term FROM t GROUP BY 1, 2 HAVING count(DISTINCT row) >= {MIN_DOCS}),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY 1),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY 1, 2, 3),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY 1, 2),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + {PRIOR})) // (coalesce(gn.total, 0) + {PRIOR} * v.v)::HUGEINT AS p
  FROM g JOIN k USING (lang) JOIN v USING (lang)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN gn ON gn.lang = g.lang AND gn.source = g.source),
q AS (
  SELECT lang, term, 1 + ({SCALE}::HUGEINT * (sum(n) + {PRIOR})) // (sum(sum(n)) OVER (PARTITION BY lang) + {PRIOR} * any_value(v.v))::HUGEINT AS q
  FROM c JOIN v USING (lang) GROUP BY 1, 2),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3) f
    ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
term AS (
  SELECT p.lang, p.source, p.term AS item, (p.p - q.q)::BIGINT AS value
  FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q)
SELECT lang, source, 'pair' AS part, item, value,
  row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pair
UNION ALL
SELECT * FROM (SELECT lang, source, 'term', item, value,
  row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM term) WHERE rank <= {TOP}"""
