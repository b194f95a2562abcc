"""Quality rules by line-first cleaning, in DataFrame functions only.

Each line of a text is judged by itself: punctuation, navigation and boilerplate rules.
Failing lines are removed; a document is rejected when the base rule fails or when too
large a share of its characters went with the removed lines.

Null or empty texts have no words, fail the base rule and are rejected.  Blank lines pass.
Rows are judged one by one, so ties, repeated rows and extra columns have no influence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import BLANKS, fresh, let, words

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
#: A document that loses more than this share of its characters is rejected.
MAX_LOST_PCT = 30
SYMBOLS = "#*$%&|<>"
#: A line ends as prose does: a stop, a colon, or a closing quote or bracket after one.
ENDS_WELL = r"[.!?…:;。！？][\"'”’»)\]]*$"
SHOUT = r"[!?]{2,}"
SEPARATOR = r"(^| )[|»›>•·]( |$)"
MENU = (r"(?i)^[^a-z]*(home|menu|log ?in|log ?out|sign ?in|sign ?up|search|next|previous|back|"
        r"share|contact( us)?|about( us)?|read more|skip to content|sitemap|top)[^a-z]*$")
BOILERPLATE = (r"(?i)(lorem ipsum|enable javascript|cookie policy|privacy policy|"
               r"terms of (use|service)|all rights reserved|accept (all )?cookies|"
               r"subscribe to our newsletter|click here)")


def _removed(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def word_chars(text: Column) -> Column:
    """Code points outside white space."""
    return F.length(F.translate(text, BLANKS, ""))


def line_fails(line: Column) -> Column:
    """Whether one line fails a rule; a line without a word never does."""
    def judge(t: Column) -> Column:
        n = F.length(t) - F.length(F.translate(t, " ", "")) + 1
        punctuation = ~t.rlike(ENDS_WELL) | (F.regexp_count(t, F.lit(SHOUT)) * 4 > n)
        navigation = (F.regexp_count(t, F.lit(SEPARATOR)) >= 3) | t.rlike(MENU)
        boilerplate = (_removed(t, SYMBOLS) * 10 > F.length(t)) | t.rlike(BOILERPLATE)
        return (F.length(t) > 0) & (punctuation | navigation | boilerplate)
    return let(F.btrim(line, F.lit(BLANKS)), judge)


def repeat_words(w: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice in the text.

    Windows are compared by a 64-bit hash; only texts with a repeated one are sorted,
    so the cost is n log n also for a very long text."""
    def covered(p: Column) -> Column:
        step = F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    def repeated(s: Column) -> Column:
        twice = F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)))
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def windows(h: Column) -> Column:
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(by_hash, repeated))

    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                         lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(hashes, windows))


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and a struct ``quality``: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, and the cleaned text (null for null).
    The struct's name gets underscores in front if ``docs`` has such a column."""
    out, = fresh(docs, "quality")
    t = F.coalesce(F.col(text), F.lit(""))

    def facts(ls: Column) -> Column:
        full = F.filter(ls, lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)
        bad = F.transform(ls, line_fails)
        return F.struct(
            let(full, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("dup"),
            let(bad, lambda b: F.struct(
                F.aggregate(F.filter(ls, lambda x, i: F.get(b, i)), F.lit(0),
                            lambda a, x: a + word_chars(x)).alias("lost"),
                F.array_join(F.filter(ls, lambda x, i: ~F.get(b, i)), "\n").alias("text"))).alias("clean"))

    lines, rep = fresh(docs, "_lines", "_repeat")
    counted = docs.withColumn(rep, let(words(F.col(text)), lambda x: F.struct(
        F.size(x).alias("n"), repeat_words(x).alias("r")))).withColumn(lines, let(F.split(t, "\n"), facts))
    n, r, chars = F.col(rep)["n"], F.col(rep)["r"], word_chars(t)
    failed = (n < MIN_WORDS) | (100 * r.cast("long") > MAX_REPEAT_PCT * n.cast("long"))
    lost = F.col(lines)["clean"]["lost"].cast("long")
    kept = ~failed & (100 * lost <= MAX_LOST_PCT * chars.cast("long"))
    return counted.withColumn(out, F.struct(
        n.cast("long").alias("n_words"), chars.cast("long").alias("word_chars"),
        _removed(t, SYMBOLS).cast("long").alias("n_symbols"),
        F.col(lines)["dup"].cast("long").alias("n_dup_lines"), r.cast("long").alias("n_repeat_words"),
        failed.alias("base_failed"), kept.alias("kept"),
        F.when(F.col(text).isNotNull(), F.col(lines)["clean"]["text"]).alias("text"),
    )).drop(rep, lines)


def kept_documents(docs: DataFrame) -> DataFrame:
    """Documents that pass, with their cleaned text and its length in ``n_chars``."""
    judged = judge(docs)
    q, = fresh(docs, "quality")
    return (judged.filter(F.col(q)["kept"])
            .withColumn("text", F.col(q)["text"])
            .withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns))


SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
p AS (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2),
g AS (SELECT r, i, ws[i:i + 2] AS g FROM p),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1),
rep AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY r),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d),
j AS (SELECT r, l, trim(l, BLANKS) AS s, length(translate(l, BLANKS, '')) AS chars FROM l),
f AS (SELECT r, l, s, chars, s <> '' AND (
        NOT regexp_matches(s, 'ENDS') OR len(regexp_extract_all(s, '[!?]{2,}')) * 4 > length(s) - length(replace(s, ' ', '')) + 1
        OR len(regexp_extract_all(s, '(^| )[|»›>•·]( |$)')) >= 3 OR regexp_matches(s, 'MENU')
        OR (length(s) - length(translate(s, '#*$%&|<>', ''))) * 10 > length(s) OR regexp_matches(s, 'BOILER')) AS bad FROM j),
ll AS (SELECT r, count(*) FILTER (WHERE s <> '') - count(DISTINCT l) FILTER (WHERE s <> '') AS dup,
         coalesce(sum(chars) FILTER (WHERE bad), 0) AS lost FROM f GROUP BY r),
b AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(translate(t, BLANKS, ''))::BIGINT AS word_chars,
        (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, dup::BIGINT AS n_dup_lines,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words, lost
      FROM d JOIN w USING (r) JOIN ll USING (r) LEFT JOIN rep USING (r)),
c AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost <= 30 * word_chars AS kept FROM c
""".replace("BLANKS", "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)") \
   .replace("ENDS", ENDS_WELL.replace("'", "''")).replace("MENU", MENU).replace("BOILER", BOILERPLATE)


def op6_quality_rules(spark, sf_dir):
    from tributary.llm.common import table
    docs = judge(table(spark, sf_dir, "documents"))
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return docs.select("doc_id", *(F.col("quality")[f].alias(f) for f in fields))
