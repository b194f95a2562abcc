"""Quality rules, line dedup, licenses, language, language model: small cases, brute force."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tributary.llm.license_texts import TEMPLATES
from tributary.llm import language_id, license_scan, line_dedup, lm_scoring, quality_rules


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_quality_base_facts(docs, empty):
    got = quality_rules.judge(docs)
    assert got.columns[-1] == "_quality" and got.count() == docs.count()
    for r in got.collect():
        q, w, lines = r["_quality"], split(r["text"]), [x for x in (r["text"] or "").split("\n") if split(x)]
        grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        again = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
        assert (q["n_words"], q["word_chars"], q["n_dup_lines"], q["n_repeat_words"]) == (
            len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(again))
        assert q["base_failed"] == (len(w) < 50 or 100 * len(again) > 50 * len(w))
        assert not (q["base_failed"] and q["kept"])
    assert quality_rules.kept_documents(empty).count() == 0
    assert quality_rules.kept_documents(docs).columns == docs.columns


@pytest.mark.parametrize("line, fails", [
    ("A sentence ends here.", False), ("He said: \"Go!\"", False), ("", False), ("   ", False), ("No stop at the end", True),
    ("home | menu | about | contact.", True), ("Read more »", True), ("THIS!! IS!! LOUD!! ALL!!", True),
    ("Please accept all cookies to go on.", True), ("a%%% b### c*** d$$$ e.", True)])
def test_line_rules(spark, line, fails):
    df = spark.createDataFrame([(line,)], "l string").select(quality_rules.line_fails(F.col("l")))
    assert df.first()[0] is fails


def brute_lines(rows, least=8):
    """Deletes every line inside a shortest stretch of ``least`` words that occurred earlier, but
    none inside the first occurrence of one."""
    first, found, out = {}, [], {}
    for i, text in rows:
        lines = [(n, x.strip(" \t\r\x0b\x0c")) for n, x in enumerate(text.split("\n")) if split(x)]
        size = [len(split(x)) for _, x in lines]
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                n = sum(size[a:b + 1])
                if n >= least and (n - size[a] < least or n - size[b] < least):
                    key = tuple(x for _, x in lines[a:b + 1])
                    first.setdefault(key, (i, a))
                    found.append((i, a, key, set(range(lines[a][0], lines[b][0] + 1))))
    times = Counter(key for _, _, key, _ in found)
    for i, text in rows:
        own = [f for f in found if f[0] == i and times[f[2]] > 1]
        later = set().union(*(f[3] for f in own if first[f[2]] != f[:2]))
        stay = set().union(*(f[3] for f in own if first[f[2]] == f[:2]))
        out[i] = "\n".join(x for n, x in enumerate(text.split("\n")) if n not in later - stay)
    return out


def test_line_dedup_against_brute_force(spark):
    shared = "Ab cd.\nThe quick brown fox jumps over the lazy dog again.\nEf.\nGh ij kl.\nMn op."
    rows = [(1, "Own line of the first text, long enough to count.\n" + shared),
            (2, shared + "\nAnother closing line that no other text has in it."),
            (3, "Gh ij kl.\nMn op.\nQr st uv."), (4, "Start.\n" + shared.split("\n", 1)[1]),
            (5, "Ef.\nGh ij kl.\nMn op.\nWx yz ab cd."), (6, "Ef.\n\nGh ij kl.\nMn op.\nWx yz ab cd.\nAb cd.")]
    got = line_dedup.delete_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["text"] for r in got.collect()} == brute_lines(rows)


def test_line_dedup_of_random_lines_against_brute_force(spark):
    import random
    draw = random.Random(5)
    pool = [" ".join(f"w{draw.randrange(40)}" for _ in range(draw.choice((1, 2, 3, 4, 6, 9, 13)))) for _ in range(25)]
    rows = [(i, "\n".join(draw.choice(pool) if draw.random() < 0.9 else "" for _ in range(draw.randrange(1, 25)))) for i in range(120)]
    got = line_dedup.delete_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert {r["doc_id"]: r["text"] for r in got.collect()} == brute_lines(rows)


def test_one_copy_of_a_run_of_equal_lines_stays(spark):
    rows = [(1, "\n".join(["one two three four"] * 5)), (2, "one two three four"), (3, "one two three four\none two three four")]
    got = line_dedup.delete_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: "one two three four\none two three four", 2: "one two three four", 3: ""}


def test_only_window_minima_are_stored(spark):
    """One fingerprint for each selected minimum, every window's least hash among them."""
    rows = [(i, "\n".join(f"{i}x{j} word" for j in range(200))) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = line_dedup._winnowed(line_dedup._lines(docs, "doc_id", "text", "\n"), 16).cache()
    picks = {tuple(r) for r in marks.filter("pick").select("d", "low_at").collect()}
    assert len(picks) == marks.filter("pick").count() < 0.4 * marks.count()
    by = {}
    for r in marks.orderBy("d", "c").collect():
        by.setdefault(r["d"], []).append(r)
    for d, ls in by.items():
        for i in range(len(ls) - 7):
            assert (d, min((x["h"], -x["c"]) for x in ls[i:i + 8])[1] * -1) in picks


def test_a_deleted_sentence_leaves_its_line_break(spark):
    passage = " ".join(f"Here sentence {n} says that the number {n} is only told once in this text." for n in ("one", "two", "three"))
    rows = [(1, passage), (2, f"Mine stays. {passage}\nThe next line.\n\n{passage}\nLast line.")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated_documents(docs).collect()}
    assert got == {1: passage, 2: "Mine stays. \nThe next line.\n\nLast line."}


def test_line_dedup_edge_cases(docs, empty):
    out = line_dedup.delete_repeats(docs)
    rows = {(r["doc_id"], r["source"]): r for r in out.collect()}
    assert out.count() == docs.count() and rows[(3, "b")]["text"] is None
    assert rows[(1, "a")]["line_dedup"]["n_removed"] == 0          # repeated rows stay alike
    assert rows[(2, None)]["text"] == "" and rows[(None, "a")]["text"].startswith("Tail of no one")
    assert len(rows[(7, "c")]["text"].split("\n")) == 3000          # repeats within one text go
    kept = {r["doc_id"] for r in line_dedup.deduplicated_documents(docs).select("doc_id").collect()}
    assert 2 not in kept and {1, 3, 4, 5, 6, None} <= kept
    assert line_dedup.delete_repeats(empty).count() == 0


def test_passages_inside_lines_are_deleted(spark):
    passage = " ".join(f"Here sentence {n} says that the number {n} is only told once in this text." for n in ("one", "two", "three", "four"))
    rows = [(1, f"A line that is first. {passage} It ends so."), (2, f"Other words begin here. {passage} Other words end here.\nA last line."),
            (3, passage.replace("three is", "nine is")), (4, "One two three. Said! Four five six."), (5, "One two three. Said! Seven."), (6, None)]
    docs = spark.createDataFrame([(i, t, "s", 0) for i, t in rows], "doc_id long, text string, source string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated_documents(docs).collect()}
    assert got == {**dict(rows), 2: "Other words begin here. Other words end here.\nA last line.",
                   3: "Here sentence three says that the number nine is only told once in this text. " + passage.split(". ")[3]}


def test_license_scan_finds_a_text_with_insertions_at_every_offset(spark):
    """60 words put into the middle of a template, the document starting it at any word."""
    template = " ".join(TEMPLATES["mit"].split()).split(" ")
    half, other = len(template) // 2, [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(other[:i * 11] + template[:half] + other[300:360] + template[half:] + other[:50])) for i in range(27)]
    rows += [(100, " ".join(template[:half]))]  # half of it is no match
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), license_scan.templates_table(spark)).collect()
    assert sorted((r["doc_id"], r["template"], r["first_word"]) for r in got) == [(i, "mit", i * 11) for i in range(27)]


def test_license_bands_decide(spark, monkeypatch):
    """Without hash functions that a window and a template share, nothing is compared."""
    docs = spark.createDataFrame([(1, TEMPLATES["mit"])], "doc_id long, text string")
    templates = license_scan.templates_table(spark)
    assert [r["containment"] for r in license_scan.scan(docs, templates).collect()] == [1.0]
    monkeypatch.setattr(license_scan, "_functions", lambda: F.explode(F.array((F.rand() * 2**62).cast("long"))))
    assert license_scan.scan(docs, templates).count() == 0


def test_licenses(spark, docs, empty):
    templates = license_scan.templates_table(spark)
    got = license_scan.scan(docs, templates).collect()
    assert [(r["doc_id"], r["template"], r["containment"], r["first_word"]) for r in got] == [(9, "mit-line", 1.0, 0)]
    assert license_scan.scan(empty, templates).count() == 0
    body = templates.filter("name = 'bsd'").first()["text"].split()
    for changed, found in ((0, True), (1, False)):
        text = "Some words come before. " + " ".join(body[:8] + ["strange"] * changed + body[8 + changed:]) + " and after."
        hit = license_scan.scan(spark.createDataFrame([(1, "# " + text.upper())], "doc_id long, text string"), templates)
        shingles = len(body) - 4
        assert bool([r for r in hit.collect() if r["template"] == "bsd"]) is ((shingles - 5 * changed) / shingles >= 0.8) is found or changed
    with pytest.raises(ValueError):
        license_scan.scan(docs, spark.createDataFrame([("x", "too short")], "name string, text string"))


def test_language(spark, docs, empty):
    model = language_id.train(docs.filter("lang is not null"))
    got = {(r["doc_id"], r["lang_pred"], r["score"] > 0) for r in language_id.predict(docs, model, ["doc_id"]).collect()}
    assert {(3, "und", False), (4, "und", False), (8, "und", False), (1, "en", True)} <= got
    nothing = language_id.train(empty)
    assert {r["lang_pred"] for r in language_id.predict(docs, nothing, ["doc_id"]).collect()} == {"und"}
    assert language_id.predict(empty, model, ["doc_id"]).count() == 0
    real = language_id.op5_language_id(spark, "/root/testdata/sf0.001")
    truth = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang")
    right = real.join(truth, "doc_id").filter("held_out").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.95


def test_language_model_base_against_brute_force(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    fold = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
    lower = lambda t: [w.lower() if w.isascii() else w for w in split(t)]
    c, texts = Counter(), 0
    for i, t in rows:
        if not fold(i):
            c.update(lower(t))
            texts += 1
    n, v = sum(c.values()) + texts, len(c) + 1
    p = lambda k: math.log10((k + 1) / (n + v + 1))
    want = sorted((str(i), fold(i), len(split(t)) + 1, sum(w in c for w in lower(t)) + 1, n,
                   round(sum(p(c[w]) for w in lower(t)) + p(texts), 6)) for i, t in rows)
    got = lm_scoring.score(docs, ~language_id.held_out(F.col("doc_id"), 7)).collect()
    assert want == sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                           round(r["base_score"], 6)) for r in got)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_language_model_without_documents(empty):
    assert lm_scoring.score(empty, F.lit(True)).count() == 0


def test_attention_is_causal_and_scores_each_id_once():
    import numpy as np
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 50, lm_scoring.VOCABULARY)
    rank = np.argsort(np.argsort(-counts, kind="stable"))
    model = lm_scoring.Model(counts, rank, rng.integers(0, lm_scoring.CLASSES, lm_scoring.VOCABULARY))
    ids = rng.integers(0, lm_scoring.VOCABULARY, 45)
    x, y = lm_scoring.windows(ids, model)
    assert y.ravel()[:45].tolist() == ids.tolist() and (y.ravel()[45:] == -1).all()
    whole = lm_scoring.log_probabilities(model, x, y).ravel()
    for cut in (1, 8, 9, 30):
        part = lm_scoring.log_probabilities(model, *lm_scoring.windows(ids[:cut], model)).ravel()
        assert np.allclose(part[:cut], whole[:cut], atol=1e-5) and (part[cut:] == 0).all()
    loss, g = lm_scoring.gradients(model, x, y)
    for k, at in (("q", (3, 4)), ("k", (1, 2)), ("v", (0, 5)), ("o", (2, 7)), ("p", (9, 3))):
        w = model.w[k].astype(float).copy()
        step = []
        for e in (1e-2, -1e-2):
            model.w[k] = w.copy()
            model.w[k][at] += e
            step.append(lm_scoring.gradients(model, x, y)[0])
        model.w[k] = w
        assert abs((step[0] - step[1]) / 2e-2 - g[k][at]) < 1e-3


def test_language_model_learns_word_order_from_every_text(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    vocabulary = [f"{a}{b}" for a in ("red", "blue", "green", "old", "new") for b in ("house", "tree", "road", "bird")]
    after = dict(zip(vocabulary, rng.permutation(vocabulary).tolist()))

    def chain(n):
        text = [str(rng.choice(vocabulary))]
        while len(text) < n:
            text.append(after[text[-1]] if rng.random() < 0.9 else str(rng.choice(vocabulary)))
        return text
    rows = [(i, " ".join(chain(60))) for i in range(40)]
    ordered = chain(200)
    rows += [(100, " ".join(ordered)), (101, " ".join(rng.permutation(ordered).tolist()))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm_scoring.score(df, F.col("doc_id") < 100).collect()}
    assert got[100]["base_score"] == pytest.approx(got[101]["base_score"])
    assert got[100]["score"] > 0.8 * got[101]["score"] and got[100]["score"] > got[100]["base_score"]

    # all ids of all texts are counted, and every text is in exactly one round of training
    texts = lm_scoring.split_texts(df)
    n = texts.agg(F.sum(F.size("ids"))).first()[0]
    assert lm_scoring.count_pairs(texts).agg(F.sum("c")).first()[0] == n
    assert texts.filter(F.col("round").between(0, lm_scoring.ROUNDS - 1)).count() == len(rows)
    # one text is enough to train on
    rank = np.arange(lm_scoring.VOCABULARY)
    model = lm_scoring.Model(np.ones_like(rank), rank, rank % lm_scoring.CLASSES)
    assert len(set(model.bucket[1000:1100])) == 100 and model.bucket[30_000] != model.bucket[30_001]
    start = model.w["q"].copy()
    for k in range(lm_scoring.ROUNDS):
        lm_scoring.train_round(texts.limit(1), model, k)
    assert not np.allclose(start, model.w["q"])


def test_probabilities_of_ids_sum_to_one():
    import numpy as np
    rng = np.random.default_rng(1)
    rank = np.arange(lm_scoring.VOCABULARY)
    counts = rng.integers(0, 9, len(rank))
    model = lm_scoring.Model(counts, rank, rng.integers(0, lm_scoring.CLASSES, len(rank)))
    model.set_pairs(np.repeat([5, 9, lm_scoring.VOCABULARY], 40), rng.choice(rank, 120, replace=False), rng.integers(1, 9, 120))
    for before in (5, 9, lm_scoring.START, 70):
        p = np.exp(model.within_class(np.full(len(rank), before), rank))
        assert np.allclose(np.bincount(model.cls, p), 1)


def test_every_pair_counts_in_a_long_corpus(spark):
    """A pair seen once counts, also among more than a million others (F1)."""
    import numpy as np
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghij"))
    texts = [" ".join("".join(rng.choice(letters, 3)) for _ in range(30)) for _ in range(12)] + ["a " * 1_100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = lm_scoring.train(df)
    encode, seen = lm_scoring._encoder(None).plain.encode_ordinary, Counter()
    for t in texts:
        ids = [lm_scoring.VOCABULARY, *encode("".join(f" {w}" for w in t.split())), lm_scoring.END]
        seen.update(zip(ids, ids[1:]))
    bucket = lambda i: lm_scoring.START if i == lm_scoring.VOCABULARY else int(model.bucket[i])
    among = Counter()
    for (i, j), c in seen.items():
        among[bucket(i), int(model.cls[j])] += c
    assert len({j for _, j in seen}) < 1000 and min(seen.values()) == 1
    want = [(c + 5 * math.exp(model.within[j])) / (among[bucket(i), int(model.cls[j])] + 5) for (i, j), c in seen.items()]
    got = np.exp(model.within_class(np.array([bucket(i) for i, _ in seen]), np.array([j for _, j in seen])))
    assert np.allclose(got, want, rtol=1e-4)


def test_ids_beyond_the_most_frequent_share_a_slot():
    import numpy as np
    rank = np.arange(lm_scoring.VOCABULARY)
    model = lm_scoring.Model(np.ones_like(rank), rank, rank % lm_scoring.CLASSES)
    a = lm_scoring.EACH + 1
    b, other = a + lm_scoring.CLASSES, a + 2 * lm_scoring.CLASSES
    model.set_pairs(np.array([7, 7]), np.array([a, b]), np.array([30, 3]))
    before = np.full(3, model.bucket[7])
    p = model.within_class(before, np.array([a, b, other]))
    assert p[0] > p[1] > p[2] and p[2] > model.within[other] - 20
    # an id before of the same class, never seen there itself: the slot's share falls back alone
    like = model.within_class(np.full(2, model.bucket[7 + lm_scoring.CLASSES]), np.array([a, b]))
    assert p[0] > like[0] > like[1]


def test_words_beyond_the_frequent_and_the_remembered(spark, monkeypatch):
    rows = [(i, " ".join(f"w{k % (i + 2)} Z{k}" for k in range(20))) for i in range(6)] + [(7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    show = lambda: sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 9))
                          for r in lm_scoring.score(df, F.col("doc_id") < 4).collect())
    want = show()
    monkeypatch.setattr(lm_scoring, "FREQUENT", 3)
    counts = lm_scoring.word_counts(df)
    assert len(lm_scoring.frequent_words(counts)) <= 3
    assert show() == want
    monkeypatch.setattr(lm_scoring, "REMEMBER", 6)
    known = lm_scoring.Words()
    for _, t in rows[:6]:
        text = t.encode().split()
        assert known.ids(text).tolist() == [i for w in text for i in known.encode(" " + w.decode())]
        assert known.ids([]).tolist() == []


def test_texts_are_encoded_at_once_as_word_by_word(docs):
    """whole texts are encoded, once for training and scoring; also with other white space in words."""
    import numpy as np
    import pyarrow as pa
    texts = ["", None, " Two\twords\n", "it's 12,5 % x　 　y    z", "  a", "a  b ", "\x85 \x85 \x1c",
             "你好 end", *(r["text"] for r in docs.select("text").limit(50).collect())]
    ids, starts = lm_scoring.ids_of(pa.array(texts, pa.string()))
    known = lm_scoring.Words()
    for text, a, b in zip(texts, starts, starts[1:]):
        assert ids[a:b].tolist() == [*known.ids((text or "").encode().lower().split()), lm_scoring.END]
    column = lm_scoring.packed(ids, starts)
    for part, first in ((column, 0), (column[3:], 3), (column[:0], 0)):
        got, at = lm_scoring.unpacked(part)
        assert at.tolist() == (starts[first:first + len(part) + 1] - starts[first]).tolist()
        assert got.tolist() == ids[starts[first]:starts[first + len(part)]].tolist()
    assert np.array_equal(lm_scoring.unpacked(pa.array([[1, 2], [3]]))[1], [0, 2, 3])


def test_groups_and_classes_sum_to_one_over_all_ids():
    """a class is given by its group and its place there; no id loses its probability."""
    import numpy as np
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 9, lm_scoring.VOCABULARY)
    rank = np.argsort(np.argsort(-counts, kind="stable"))
    cls = lm_scoring.grouped(rng.random((lm_scoring.CLASSES, 6)))[rng.integers(0, lm_scoring.CLASSES, len(rank))]
    assert set(cls) == set(range(lm_scoring.CLASSES))
    model = lm_scoring.Model(counts, rank, cls)
    model.set_transitions(rng.integers(0, 9, (lm_scoring.BUCKETS + 1) * lm_scoring.CLASSES))
    model.w = {k: 3 * w for k, w in model.w.items()}
    x, y = lm_scoring.windows(rng.integers(0, len(rank), 3 * lm_scoring.HALF), model)
    x, y = np.repeat(x[1:2], len(rank), axis=0), np.repeat(y[1:2], len(rank), axis=0)
    y[:, 4] = np.arange(len(rank))
    assert np.isclose(np.exp(lm_scoring.log_probabilities(model, x, y)[:, 4]).sum(), 1, atol=1e-4)
