"""Spelling variants of words, found by pivotal grams.

Words with enough occurrences in the corpus are near if they differ by exactly one inserted,
deleted or replaced code point.  A word's bigrams are ordered by how many words have them,
rare first.  Its prefix is its first three bigrams in that order (and all that equal the
third): one edit destroys at most two bigrams.  Its pivots are two bigrams of the prefix that
do not overlap, the rarest such pair by dynamic programming: one edit destroys at most one of
them.  Of two near words take the one whose prefix ends at the rarer bigram: one of its pivots
is in the other's prefix.  So each word's pivots are looked up in the index of all prefixes.

Position limits: the edit lies on one side of the pivot that it spares.  If it is to the
right, the words agree from their start through the pivot; if to the left, from the pivot to
their end.  The index key is that whole side of the word, with the length of the indexed word,
so a frequent bigram is no hot key.  Candidates are verified by edit distance.

A word's form is its near word with the most occurrences (ties: smallest in code-point
order), if that has ``RATIO`` times its own or more.  Forms are followed by doubling: an
occurrence count grows by ``RATIO`` a step, so there are few steps.

Null texts have no words, and a null doc_id reads as ''.  Rows that repeat count each time.
Occurrences are combined in the task before any shuffle, and its table of counts is given on
when it reaches ``FLUSH`` words.  The bigram order is the only thing broadcast: its alphabet
has 90 letters, so it has at most 8,100 bigrams.  An empty table, or one without common words,
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import stored, table

#: Runs of letters, once A-Z are lowered.
RUN = re.compile("[a-zÀ-ÿ]+")
#: The noise of the contract: one run in NOISE loses a code point.
NOISE = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
FLUSH = 200_000
#: Bytes of text between two looks at the size of a task's table.
LOOK = 1 << 20

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(doc_id, text: str | None) -> Counter:
    """The words of a document with their occurrences."""
    out: Counter = Counter()
    head = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall((text or "").encode().translate(_LOWER).decode())).items():
        h = crc32(run.encode(), head)
        if h % NOISE == 0:
            cut = h % len(run)
            run = run[:cut] + run[cut + 1:]
        if len(run) >= LEAST_LENGTH:
            out[run] += n
    return out


def vocabulary(docs: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): all words with at least ``least_count`` occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def given() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return out
        unseen = 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                counts.update(words_of(doc_id, text))
                unseen += len(text or "")
                if unseen >= LOOK:
                    unseen = 0
                    if len(counts) >= FLUSH:
                        yield given()
        if counts:
            yield given()
    return (docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count))


# -- grams -----------------------------------------------------------------------------------
def gram_order(words: DataFrame) -> dict[str, int]:
    """The place of each bigram, rare first (ties by the bigram); at most 8,100 entries."""
    starts = F.sequence(F.lit(1), F.length("word") - 1)
    grams = F.array_distinct(F.transform(starts, lambda i: F.substring(F.col("word"), i, F.lit(2))))
    rows = words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["gram"]: i for i, r in enumerate(sorted(rows, key=lambda r: (r["n"], r["gram"])))}


def prefix_grams(word: str, order: dict[str, int]) -> list[tuple[int, int]]:
    """(place in the order, position) of the word's first three bigrams, and of all as frequent as the third."""
    grams = sorted((order[word[i:i + 2]], i) for i in range(len(word) - 1))
    return [g for g in grams if g[0] <= grams[2][0]]


def pivots(prefix: list[tuple[int, int]], count: int = 2) -> list[tuple[int, int]]:
    """``count`` bigrams of the prefix that do not overlap, with the least sum of places.

    best[k][i]: the least sum for k bigrams among the first i by position."""
    grams = sorted(prefix, key=lambda g: g[1])
    best: list[list[tuple[int, list]]] = [[(0, [])] * (len(grams) + 1)]
    for k in range(1, count + 1):
        row: list = [None]
        for i, g in enumerate(grams, 1):
            before = sum(1 for h in grams[:i - 1] if h[1] + 2 <= g[1])
            take = best[k - 1][before]
            taken = None if take is None else (take[0] + g[0], [*take[1], g])
            row.append(min((x for x in (row[-1], taken) if x), key=lambda x: x[0], default=None))
        best.append(row)
    return best[count][-1][1]


def _sides(word: str, position: int) -> list[tuple[str, str]]:
    """What two words share if they agree on this bigram: all to its left, or all to its right."""
    return [("L", word[:position + 2]), ("R", word[position:])]


def _entries(order, role: str):
    """Rows (side, part, length, word, n, last): the index of prefixes, or the probes of pivots
    (a probe names the length of the word it looks for)."""
    schema = pa.schema([("side", pa.string()), ("part", pa.string()), ("length", pa.int32()),
                        ("word", pa.string()), ("n", pa.int64()), ("last", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part, rows = b.slice(at, 4096), []
                for word, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    prefix = prefix_grams(word, order.value)
                    last = prefix[-1][0]
                    if role == "index":
                        rows += [(*s, len(word), word, n, last) for _, i in prefix for s in _sides(word, i)]
                    else:
                        rows += [(*s, len(word) + d, word, n, last) for _, i in pivots(prefix) for s in _sides(word, i) for d in (-1, 0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    return run, "side string, part string, length int, word string, n long, last int"


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words at edit distance one."""
    order = words.sparkSession.sparkContext.broadcast(gram_order(words))
    probes = words.select("word", "n").mapInArrow(*_entries(order, "probe")).select(
        "side", "part", "length", F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("last").alias("a_last"))
    index = words.select("word", "n").mapInArrow(*_entries(order, "index")).select(
        "side", "part", "length", F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("last").alias("b_last"))
    # The rarer prefix end probes; of equal ones the smaller word does.
    probing = (F.col("a_last") < F.col("b_last")) | ((F.col("a_last") == F.col("b_last")) & (F.col("a") < F.col("b")))
    found = (probes.join(index, ["side", "part", "length"]).filter(probing)
             .filter(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n").distinct())
    both = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
                             F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))))
    return found.select(both.alias("pair")).select("pair.*")


def variants(docs: DataFrame, *, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    spark = docs.sparkSession
    words = stored(spark, vocabulary(docs, least_count), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near")))
    linked = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    formed = -F.col("best.rank") >= F.col("n") * ratio
    named = stored(spark, words.join(linked, "word", "left").select(
        "word", F.when(formed, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(formed, -F.col("best.rank")).alias("form_n")), "spelling-forms")
    # Pointer doubling over the words that have a form: after round i a word points 2^i steps on.
    steps = named.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(spark, steps.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        steps = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            break
    return named.join(steps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark, sf_dir):
    return variants(table(spark, sf_dir, "documents"))
