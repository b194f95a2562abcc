"""License scans: MinHash bands retrieve templates, exact containment verifies them, in
DataFrame functions only.

Texts and templates are lower-cased runs of letters and digits.  Overlapping windows of
``WIDTH`` words start every ``STEP`` words and hold four 5-word shingles; each is hashed by
``HASHES`` functions, of which the least and the greatest value over the shingles are a band
each.  A template is laid out as its single shingles, whose hash by a function is both of its
bands.  A window that holds a shingle of a template has it as the least or the greatest of
its four by a function with probability 1/2, so it misses the template with 0.5 ^ 24 < 1e-7.
The bands decide: only windows that share one with a template are compared with it.

Verified: the share of the template's distinct shingles that lie, in retrieved windows, within
one of the overlapping text windows of three template lengths, a window starting every template
length.  So any stretch of twice the template's length is within one, wherever the document
has it.  At ``CONTAINMENT`` or more it is a match.  The text is read once and never shuffled;
what the bands retrieve is.

Null and empty texts, and texts under five words, match nothing.  Rows equal in doc_id and
text give one row per template; rows are named by 128 bits of hash.  Repeated license texts
in a document cost one row per shingle.  Templates are a table (name, text), its bands a
broadcast one of at most ``MAX_BANDS`` rows (more are an error); templates under five words
are an error, too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import let, table
from tributary.llm.license_texts import TEMPLATES

SHINGLE = 5
STEP = 4
WIDTH = STEP + SHINGLE - 1
HASHES = 24
CONTAINMENT = 0.8
#: Text windows are this many template lengths.
LENGTHS = 3
#: Bands of all templates: some 170,000 words of them, 100 MB where they are looked up.
MAX_BANDS = 4_000_000
NOT_WORD = r"[^\p{L}\p{N}]+"


def license_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def _windows(text: Column) -> Column:
    """Array of (at, s): the first word's place and the hashes of the window's shingles (a
    window at the end of the text repeats its last shingle)."""
    def cut(w: Column) -> Column:
        last = F.size(w) - SHINGLE
        shingle = [lambda i, k=k: let(F.least(i + k, last), lambda j: F.xxhash64(*(F.get(w, j + x) for x in range(SHINGLE))))
                   for k in range(STEP)]
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last, F.lit(STEP)), lambda i: F.struct(
            i.alias("at"), *(s(i).alias(f"s{k}") for k, s in enumerate(shingle)))))
    return let(license_words(text), cut)


def _functions() -> Column:
    """One row per hash function: the number it mixes into what it hashes."""
    return F.explode(F.array(*[F.lit((k * 0x9E3779B97F4A7C15 + 2**63) % 2**64 - 2**63) for k in range(HASHES)]))


def scan(docs: DataFrame, templates: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, template, containment, first_word), one row per document and template found:
    the best window's containment, and the first word of a shingle in it (the first, on ties)."""
    spark = docs.sparkSession
    four = [f"s{k}" for k in range(STEP)]
    # all of this is bounded by the table of templates
    texts = templates.select("name", F.size(license_words(F.col("text"))).alias("words"), _windows(F.col("text")).alias("w")).collect()
    if short := [r["name"] for r in texts if r["words"] < SHINGLE]:
        raise ValueError(f"templates of under {SHINGLE} words: {short}")
    held_by = {r["name"]: {s for w in r["w"] for s in w[1:]} for r in texts}
    if (bands := HASHES * sum(map(len, held_by.values()))) > MAX_BANDS:
        raise ValueError(f"{bands} bands of templates, at most {MAX_BANDS} are broadcast")
    of_shingle = spark.createDataFrame([(r["name"], s, len(held_by[r["name"]]), r["words"]) for r in texts for s in sorted(held_by[r["name"]])],
                                       "name string, s long, shingles long, words long")
    of_band = of_shingle.select("name", "s", _functions().alias("f")).select("name", F.xxhash64(F.col("s").bitwiseXOR(F.col("f"))).alias("band"))

    found = docs.select(F.xxhash64(F.col(text), F.col(doc_id)).alias("k1"), F.xxhash64(F.lit(1), F.col(text), F.col(doc_id)).alias("k2"),
                        F.col(doc_id).alias("doc_id"), F.explode(_windows(F.col(text))).alias("w")).select("k1", "k2", "doc_id", "w.*")
    hashed = found.select("*", _functions().alias("f")).select(
        "k1", "k2", "doc_id", "at", *four, F.array(*[F.xxhash64(F.col(s).bitwiseXOR(F.col("f"))) for s in four]).alias("h"))
    retrieved = (hashed.select("k1", "k2", "doc_id", "at", *four, F.explode(F.array(F.array_min("h"), F.array_max("h"))).alias("band"))
                 .join(F.broadcast(of_band), "band").drop("band"))
    places = retrieved.select("k1", "k2", "doc_id", "name", "at", F.posexplode(F.array(*four)).alias("k", "s")).select(
        "k1", "k2", "doc_id", "name", "s", (F.col("at") + F.col("k")).alias("at"))
    row = ["k1", "k2", "doc_id", "name", "shingles"]
    matched = (places.join(F.broadcast(of_shingle), ["name", "s"])
               .withColumn("last", F.floor(F.col("at") / F.col("words")))
               # the windows [c * words, (c + LENGTHS) * words) that hold the whole shingle
               .withColumn("c", F.explode(F.array(*[F.col("last") - x for x in range(LENGTHS)])))
               .filter((F.col("c") >= 0) & (F.col("at") + SHINGLE <= (F.col("c") + LENGTHS) * F.col("words"))))
    shares = matched.groupBy(*row, "c", "s").agg(F.min("at").alias("at")).groupBy(*row, "c").agg(
        F.count("*").alias("n"), F.min("at").alias("at"))
    best = shares.filter(F.col("n") >= CONTAINMENT * F.col("shingles")).groupBy("k1", "k2", "doc_id", "name").agg(
        F.max(F.struct((F.col("n") / F.col("shingles")).alias("containment"), (-F.col("at")).alias("back"))).alias("b"))
    return best.select("doc_id", F.col("name").alias("template"), F.col("b.containment").alias("containment"),
                       (-F.col("b.back")).cast("long").alias("first_word"))


def templates_table(spark) -> DataFrame:
    return spark.createDataFrame([(k, " ".join(v.split())) for k, v in TEMPLATES.items()], "name string, text string")


def op10_license_scan(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"), templates_table(spark))


def sql() -> str:
    rows = ", ".join("('{}', '{}')".format(k, " ".join(v.split()).replace("'", "''")) for k, v in TEMPLATES.items())
    return rf"""
WITH t AS (SELECT name, list_filter(regexp_split_to_array(lower(body), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM (VALUES {rows}) AS v(name, body)),
ts AS (SELECT DISTINCT name, len(w) AS words, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM t),
tn AS (SELECT name, count(*) AS shingles FROM ts GROUP BY name),
d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5),
ds AS (SELECT doc_id, i - 1 AS pos, array_to_string(w[i:i + 4], ' ') AS s FROM p),
m AS (SELECT DISTINCT doc_id, pos, s, name, words, unnest([pos // words - 2, pos // words - 1, pos // words]) AS c FROM ds JOIN ts USING (s)),
sh AS (SELECT doc_id, name, c, count(DISTINCT s) AS n, min(pos) AS pos FROM m
       WHERE c >= 0 AND pos + 5 <= (c + 3) * words GROUP BY doc_id, name, c),
r AS (SELECT doc_id, name, n / shingles AS containment, pos,
             row_number() OVER (PARTITION BY doc_id, name ORDER BY n DESC, pos) AS k
      FROM sh JOIN tn USING (name) WHERE n >= 0.8 * shingles)
SELECT doc_id, name AS template, containment::DOUBLE AS containment, pos::BIGINT AS first_word FROM r WHERE k = 1
"""
