"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts every n-gram (lengths ``NGRAMS``) of every labelled training text, hashed
into ``BUCKETS`` buckets; each task counts in numpy and its counts are summed by Spark.  The
matrix of log probabilities (buckets x languages, at most ``MAX_LANGUAGES`` of them, so its
size is bounded whatever the corpus) is broadcast, and batches are scored in numpy: rows of
the matrix are looked up for all n-grams of a batch and summed per document.

A text that is null or has no letter is ``und`` with score 0.  The score is the predicted
language's posterior.  Ties go to the first language in code point order.  Without training
rows every text is ``und``.  A null doc_id counts as the empty text for the held-out fold.
Rows are judged one by one; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import table

NGRAMS = (1, 2, 3)
BUCKETS = 1 << 15
SMOOTHING = 0.5
MAX_LANGUAGES = 1000
#: Characters hashed at a time: bounds memory for a very long text.
CHUNK = 1 << 20
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def held_out(doc_id: Column, folds: int, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == fold


def grams(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of the n-grams of a text in lower case, white space as one blank."""
    code = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, len(code), CHUNK):
        part = code[at:at + CHUNK + max(NGRAMS) - 1]
        here = min(CHUNK, len(code) - at)
        h = np.zeros(len(part), np.uint32)
        for n in range(1, max(NGRAMS) + 1):
            h = (h[:len(part) - n + 1] * np.uint32(0x01000193)) ^ (part[n - 1:] * np.uint32(0x9E3779B1))
            if n in NGRAMS:
                x = h[:here]
                yield ((x ^ (x >> np.uint32(15))) * np.uint32(0x85EBCA6B) + np.uint32(n)) >> np.uint32(32 - 15)


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log priors, log probabilities of shape (buckets, languages))."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for b in batches:
            for t, k in zip(b.column(0), b.column(1).to_pylist()):
                own = counts.get(k)
                if own is None:
                    own = counts[k] = np.zeros(BUCKETS + 1, np.int64)
                own[-1] += 1
                for g in grams(t.as_py()):
                    own[:-1] += np.bincount(g, minlength=BUCKETS)
        for k, own in counts.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(at), pa.string()), pa.array(at, pa.int32()),
                                              pa.array(own[at], pa.int64())], names=["lang", "bucket", "n"])
    rows = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text), F.col(lang))
    if rows.select(lang).distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages")
    sums = rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # at most languages x buckets numbers
    got = sums.groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n")).orderBy("lang").collect()
    langs = [r["lang"] for r in got]
    counts = np.zeros((len(langs), BUCKETS + 1))
    for i, r in enumerate(got):
        counts[i, r["b"]] = r["n"]
    n, grams_ = counts[:, -1], counts[:, :-1]
    prior = np.log(n / max(n.sum(), 1)) if langs else n
    prob = np.log((grams_ + SMOOTHING) / (grams_.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS))
    return langs, prior, np.ascontiguousarray(prob.T, np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], keep: list[str],
            text: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred and score."""
    spark = docs.sparkSession
    langs, prior, prob = model
    shared = spark.sparkContext.broadcast((prior, prob))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prior, prob = shared.value
        for b in batches:
            pred, score = [], []
            for t in b.column(b.num_columns - 1):
                t = t.as_py()
                if not langs or t is None or not _LETTER.search(t):
                    pred.append(UNKNOWN)
                    score.append(0.0)
                    continue
                total = prior.copy()
                for g in grams(t):
                    if len(g) > BUCKETS:
                        total += np.bincount(g, minlength=BUCKETS).astype(np.float64) @ prob
                    else:
                        total += prob[g].sum(axis=0, dtype=np.float64)
                best = int(total.argmax())
                pred.append(langs[best])
                score.append(float(1.0 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             names=[*keep, "lang_pred", "score"])
    chosen = docs.select(*keep, F.col(text).alias("_text_to_judge"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return chosen.mapInArrow(run, f"{schema}, lang_pred string, score double")


def op5_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", held_out(F.col("doc_id"), 4).alias("held_out"))
    model = train(docs.filter(~F.col("held_out")))
    return predict(docs, model, ["doc_id", "held_out"])
