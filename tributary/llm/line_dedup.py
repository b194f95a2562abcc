"""Line dedup by winnowing over line hashes, in DataFrame functions only.

1. A window is the shortest stretch of consecutive lines from a line on that holds at least
   ``MIN_WORDS`` words.  Of each window the least line hash is selected (the last on ties);
   neighbouring windows mostly share it.  One row per selected minimum is its fingerprint:
   texts that share a stretch of so many words share a window, hence a fingerprint.
2. Fingerprints are counted.  Only positions of those that occur twice go on, and documents
   without one are done.
3. Around these positions matches are extended both ways, line by line: to the right by the
   windows that the fingerprint stands for, to the left and to the end of a stretch by the
   shortest stretches up to a line.  Each has its first position by fingerprint and hash of all
   its lines, never pairwise: a line in a third of all documents costs one row per
   occurrence, and the few groups with over a thousandth of all rows are joined unshuffled.
4. A line goes if it lies in a later occurrence of such a stretch, unless it also lies in the
   first occurrence of one: one whole copy of every repeated stretch stays.

Passages inside lines: ``deduplicated_documents`` then takes sentences for lines, with stretches
of ``PASSAGE_WORDS`` words, so that a repeat goes that begins or ends inside a line or differs in
one sentence of it; the line's break stays with what is left of it.  ``op9_line_dedup`` deletes
whole lines alone.

Order: by doc_id (null last), then position.  Lines are compared without white space at
their ends; lines without a word are skipped, and go only inside a deleted stretch.  Null
texts stay null.  Rows equal in doc_id and text count as one document and stay alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.llm.common import BLANKS, SPLIT, fresh, let, stored, table

#: Shortest repeated stretch, in words, that is deleted.
MIN_WORDS = 8
#: The same in sentences inside lines: a repeat of 50 words holds so many in whole sentences,
#: if the ones cut at its ends have no more than the rest.
PASSAGE_WORDS = 25
#: After a sentence's end and the white space (kept with it), and around a line's break.
SENTENCES = "(?<=[.!?\u2026\u0964\u061f\u06d4][ \t])|(?<=[.!?\u2026][\"')\u201d\u00bb][ \t])|(?<=\n)|(?=\n)"
#: Stands for deleted sentences until the lines are put together; not a character.
GONE = "\uffff"
LAST = 2**63 - 1
#: Groups with over one in so many rows are hot; there are fewer of them than this.
HOT_SHARE = 1000
KEY = ("k1", "k2")


def _keys(doc_id: Column, text: Column) -> list[Column]:
    """128 bits that identify a row by id and text."""
    return [F.xxhash64(doc_id, text, F.length(text)).alias("k1"), F.xxhash64(F.lit(1), text, doc_id).alias("k2")]


def _lines(docs: DataFrame, doc_id: str, text: str, cut: str) -> DataFrame:
    """(k1, k2, d, no, h, n, c): the lines with a word, their number in the text, hash, words,
    and words before them."""
    raw = docs.select(*_keys(F.col(doc_id), F.col(text)), F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("d"),
                      F.posexplode(F.split(F.col(text), cut)).alias("no", "raw"))
    lines = raw.withColumn("raw", F.btrim("raw", F.lit(BLANKS))).filter(F.length("raw") > 0).select(
        *KEY, "d", "no", F.xxhash64("raw").alias("h"), F.size(F.split("raw", SPLIT)).cast("long").alias("n"))
    in_text = Window.partitionBy(*KEY).orderBy("no")
    once = lines.withColumn("before", F.lag("no").over(in_text)).filter(~F.col("before").eqNullSafe(F.col("no")))
    return once.drop("before").withColumn("c", F.sum("n").over(in_text.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))


def _winnowed(lines: DataFrame, min_words: int) -> DataFrame:
    """``lines`` with the window from each line on: low, low_at (its least hash and that line's
    c; null if it is short of words), pick (the first window that selects this minimum)."""
    at = Window.partitionBy(*KEY).orderBy("c")
    window = at.rangeBetween(0, min_words - 1)
    least = (lines.withColumn("least", F.min(F.struct("h", (-F.col("c")).alias("back"))).over(window))
             .withColumn("full", F.sum("n").over(window) >= min_words))
    least = least.select(*lines.columns, F.when(F.col("full"), F.col("least")["h"]).alias("low"),
                         F.when(F.col("full"), -F.col("least")["back"]).alias("low_at"))
    return least.withColumn("pick", F.col("low").isNotNull() & ~F.col("low_at").eqNullSafe(F.lag("low_at").over(at)))


def _join_groups(rows: DataFrame, groups: DataFrame, by: list[str], total: int) -> DataFrame:
    """``rows`` joined with their group (with ``times``, its rows): hot groups, fewer than
    ``HOT_SHARE``, are broadcast, the others are joined by key."""
    hot = F.broadcast(groups.filter(F.col("times") * HOT_SHARE > total))
    rest = rows.join(hot, by, "left_anti").join(groups.filter(F.col("times") * HOT_SHARE <= total), by)
    return rows.join(hot, by).unionByName(rest)


def _stretches(marks: DataFrame, hits: DataFrame, min_words: int) -> DataFrame:
    """(low, all, k1, k2, d, from_no, to_no): the shortest stretches from a line on, and up to a
    line, whose fingerprint is among ``hits`` (k1, k2, low_at)."""
    columns = [*KEY, "d", "no", "h", "n", "c", "low", "low_at"]
    both = (marks.select(*columns, F.lit(False).alias("hit"))
            .unionByName(hits.withColumn("hit", F.lit(True)), allowMissingColumns=True).repartition(*KEY))
    both = (both.withColumn("hit", F.max("hit").over(Window.partitionBy(*KEY, "low_at")) & F.col("low").isNotNull())
            .filter(F.col("no").isNotNull())
            .withColumn("any", F.max("hit").over(Window.partitionBy(*KEY))).filter("any"))
    on = Window.partitionBy(*KEY).orderBy("c").rangeBetween(0, min_words - 1)
    upto = Window.partitionBy(*KEY).orderBy("e").rangeBetween(1 - min_words, 0)
    right = both.withColumn("all", F.xxhash64(F.collect_list("h").over(on))).withColumn("to_no", F.max("no").over(on))
    left = (right.withColumn("e", F.col("c") + F.col("n"))
            .withColumn("start", F.first(F.struct("low", "hit", "no", "c")).over(upto))
            .withColumn("left_all", F.xxhash64(F.collect_list("h").over(upto))))
    # a stretch up to a line that is also the shortest from its first line on is there already
    apart = F.col("start")["hit"] & (F.col("c") - F.col("start")["c"] >= min_words)
    found = F.array(
        F.when(F.col("hit"), F.struct("low", "all", F.col("no").alias("from_no"), "to_no")),
        F.when(apart, F.struct(F.col("start")["low"].alias("low"), F.col("left_all").alias("all"),
                               F.col("start")["no"].alias("from_no"), F.col("no").alias("to_no"))))
    return left.select(*KEY, "d", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("w")).select(
        "w.low", "w.all", *KEY, "d", "w.from_no", "w.to_no")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id",
                  text: str = "text", cut: str = "\n") -> DataFrame:
    """(k1, k2, lines): the numbers of the lines to delete, one row per affected document."""
    spark = docs.sparkSession
    marks = stored(spark, _winnowed(_lines(docs, doc_id, text, cut), min_words), "line-marks")
    picks = marks.filter("pick").select("low", *KEY, "low_at")
    repeated = picks.groupBy("low").agg(F.count("*").alias("times")).filter("times > 1")
    hits = _join_groups(picks, repeated, ["low"], picks.count()).select(*KEY, "low_at")
    found = stored(spark, _stretches(marks, hits, min_words), "line-stretches")
    at = F.struct("d", *KEY, "from_no")
    groups = (found.groupBy("low", "all").agg(F.count("*").alias("times"), F.min(at).alias("first"))
              .filter("times > 1"))
    lines = F.sequence("from_no", "to_no")
    return (_join_groups(found, groups, ["low", "all"], found.count())
            .groupBy(*KEY).agg(F.array_distinct(F.flatten(F.collect_set(F.when(at > F.col("first"), lines)))).alias("later"),
                               F.flatten(F.collect_set(F.when(at == F.col("first"), lines))).alias("first"))
            .select(*KEY, F.array_except("later", "first").alias("lines")).filter(F.size("lines") > 0))


def _without(text: Column, gone: Column, cut: str) -> Column:
    """The text without the lines numbered in ``gone``."""
    if cut == "\n":
        return let(F.split(text, cut), lambda x: F.array_join(F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(x) - 1), gone), lambda i: F.get(x, i)), "\n"))
    # sentences go, breaks stay, and then lines of which nothing is left go with their break
    def marked(x: Column) -> Column:
        kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), gone), lambda i: F.struct(i.alias("i"), F.get(x, i).alias("s")))
        left = F.transform(gone, lambda i: F.struct(i.alias("i"), F.when(F.get(x, i) == "\n", "\n").otherwise(GONE).alias("s")))
        return F.array_join(F.transform(F.sort_array(F.concat(kept, left)), lambda p: p["s"]), "")
    bare = F.regexp_replace(let(F.split(text, cut), marked), f"(?m)^[ \\t]*{GONE}[{GONE} \\t]*(\\n|\\z)", "")
    return F.regexp_replace(bare, GONE, "")


def delete_repeats(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id",
                   text: str = "text", cut: str = "\n") -> DataFrame:
    """All columns of ``docs`` with later repeated runs deleted from the text, and a struct
    ``line_dedup``: n_lines (0 for null), n_removed.  Lines are what ``cut`` splits the text into."""
    k1, k2, gone, out = fresh(docs, "k1", "k2", "gone", "line_dedup")
    runs = repeated_runs(docs, min_words, doc_id, text, cut).toDF(k1, k2, gone)
    keys = [k.alias(name) for k, name in zip(_keys(F.col(doc_id), F.col(text)), (k1, k2))]
    joined = docs.select("*", *keys).join(runs, [k1, k2], "left")
    return joined.select(
        *(F.when(F.col(gone).isNull(), F.col(c)).otherwise(_without(F.col(text), F.col(gone), cut)).alias(c)
          if c == text else F.col(c) for c in docs.columns),
        F.struct(F.coalesce(F.size(F.split(F.col(text), cut)), F.lit(0)).cast("long").alias("n_lines"),
                 F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_removed")).alias(out))


def _left(done: DataFrame, columns: list[str], flag: str) -> DataFrame:
    """A document of which no word is left was a copy of earlier ones throughout, and goes."""
    return (done.filter((F.col(flag)["n_removed"] == 0) | (F.length(F.btrim("text", F.lit(BLANKS))) > 0))
            .withColumn("n_chars", F.length("text").cast("long")).select(*columns))


def deduplicated_documents(docs: DataFrame) -> DataFrame:
    """``docs`` without their later repeated runs of lines, and of sentences inside lines."""
    out, = fresh(docs, "line_dedup")
    lines = _left(delete_repeats(docs), docs.columns, out)
    return _left(delete_repeats(lines, PASSAGE_WORDS, cut=SENTENCES), docs.columns, out)


def op9_line_dedup(spark, sf_dir):
    out = delete_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("line_dedup")["n_lines"].alias("n_lines"),
                      F.col("line_dedup")["n_removed"].alias("n_removed"), "text")


SQL = r"""
WITH d AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) AS r FROM documents),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS raw, unnest(range(len(string_split(text, chr(10))))) AS no FROM d),
t AS (SELECT *, trim(raw, BLANKS) AS s, len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) AS n FROM l),
f AS (SELECT r, no, s, n, row_number() OVER (PARTITION BY r ORDER BY no) AS i,
             sum(n) OVER (PARTITION BY r ORDER BY no) AS upto FROM t WHERE n > 0),
pairs AS (SELECT a.r, a.i, b.i AS j, a.no AS from_no, b.no AS to_no, b.upto - a.upto + a.n AS n, a.n AS first_n, b.n AS last_n
          FROM f a JOIN f b ON a.r = b.r AND b.i BETWEEN a.i AND a.i + 7),
win AS (SELECT * FROM pairs WHERE n >= 8 AND (n - first_n < 8 OR n - last_n < 8)),
keyed AS (SELECT w.r, w.i, w.j, any_value(w.from_no) AS from_no, any_value(w.to_no) AS to_no, string_agg(f.s, chr(10) ORDER BY f.i) AS g
          FROM win w JOIN f ON f.r = w.r AND f.i BETWEEN w.i AND w.j GROUP BY w.r, w.i, w.j),
firsts AS (SELECT *, r * 1000000 + from_no = min(r * 1000000 + from_no) OVER (PARTITION BY g) AS is_first,
                  count(*) OVER (PARTITION BY g) AS times FROM keyed),
marked AS (SELECT r, unnest(range(from_no, to_no + 1)) AS no, is_first FROM firsts WHERE times > 1),
del AS (SELECT r, no FROM marked GROUP BY r, no HAVING NOT bool_or(is_first)),
text AS (SELECT r, count(*) AS n_lines, count(del.no) AS n_removed,
                coalesce(string_agg(raw, chr(10) ORDER BY no) FILTER (WHERE del.no IS NULL), '') AS text
         FROM l LEFT JOIN del USING (r, no) GROUP BY r)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, text.text AS text
FROM d LEFT JOIN text USING (r)
""".replace("BLANKS", "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)")
