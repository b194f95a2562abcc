"""Operators 11 to 13: against SQL, brute force and rows made to be awkward."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tributary.llm import exact_dedup, source_divergence, spelling_variants

SF = "/root/testdata/sf0.001"


def from_sql(sql, frame):
    con = duckdb.connect()
    con.register("documents", frame.toArrow())
    return sorted(map(repr, con.sql(sql).fetchall()))


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


# -- op13 --------------------------------------------------------------------------------
def test_golomb_round_trip():
    rng = np.random.default_rng(1)
    for n, width in ((1, 1), (5, 3), (1000, 20), (3000, 40), (1, 60)):
        values = np.unique(rng.integers(0, 1 << width, n))
        shift = exact_dedup.divisor_shift(len(values), width)
        unary, rest = exact_dedup.encode(values, shift)
        assert (exact_dedup.decode(len(values), shift, unary, rest) == values).all()
    values = np.unique(rng.integers(0, 1 << 40, 4000))
    unary, rest = exact_dedup.encode(values, exact_dedup.divisor_shift(len(values), 40))
    assert 8 * (len(unary) + len(rest)) < len(values) * (np.log2(2 ** 40 / len(values)) + 2)


def test_exact_dedup_equals_sql(spark, docs):
    narrow = docs.select("doc_id", "text")
    got = exact_dedup.with_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert rows(got) == from_sql(exact_dedup.SQL, narrow)


def test_exact_dedup_many_owners_and_blocks(spark, monkeypatch):
    """One copy group of a third of the rows, over several blocks and owners."""
    monkeypatch.setattr(exact_dedup, "OWNER_ROWS", 64)
    monkeypatch.setattr(exact_dedup, "BLOCK_ROWS", 64)
    data = [(i, "the very  same" if i % 3 == 0 else f"t {i % 170}" + " " * (i % 4)) for i in range(900)]
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(5, "doc_id")
    got = exact_dedup.with_duplicates(frame).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert rows(got) == from_sql(exact_dedup.SQL, frame)


def test_exact_dedup_ties_and_clashing_columns(spark, empty):
    data = [(5, "a b", 1, "x"), (5, "a b", 1, "x"), (None, "ab ", 2, "y"), (4, "a\tb", 3, "z"), (7, "a  b", 4, "w"), (9, None, 5, None), (8, " ", 6, "")]
    frame = spark.createDataFrame(data, "doc_id long, text string, kept long, sha string")
    got = {(r["doc_id"], r["kept"], r["keep_id"], r["group_size"]) for r in exact_dedup.with_duplicates(frame).collect()}
    assert got == {(5, False, 7, 5), (None, False, 7, 5), (4, False, 7, 5), (7, True, 7, 5), (9, False, 8, 2), (8, True, 8, 2)}
    left = exact_dedup.kept_documents(frame)
    assert left.columns == frame.columns
    assert sorted(map(tuple, left.collect())) == [(7, "a  b", 4, "w"), (8, " ", 6, "")]
    same = spark.createDataFrame([(1, "q"), (1, "q"), (1, "q ")], "doc_id long, text string")
    assert sorted(r["kept"] for r in exact_dedup.with_duplicates(same).collect()) == [False, False, True]
    twins = spark.createDataFrame([(1, "q"), (1, "q")], "doc_id long, text string")
    assert exact_dedup.kept_documents(twins).count() == 1
    assert exact_dedup.with_duplicates(empty).count() == 0


def test_exact_dedup_moves_only_suspects(spark):
    """Fingerprints of texts without a copy never reach the shuffle of texts."""
    data = [(i, f"text number {i}") for i in range(400)] + [(1000, "text number 7")]
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    assert sum(1 for r in exact_dedup.with_duplicates(frame).collect() if r["group_size"] > 1) == 2


# -- op11 --------------------------------------------------------------------------------
def divergence_by_hand(data, min_docs, prior, scale, top):
    docs = [(lang or "", source or "", re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")) for lang, source, text in data]
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    docs = [(lang, source, [lower(t) for t in found]) for lang, source, found in docs]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for _, _, found in mine for t in set(found))
        kept = sorted(t for t, n in df.items() if n >= min_docs)
        counts = defaultdict(Counter)
        for _, source, found in mine:
            counts[source].update(t for t in found if t in set(kept))
            counts[source] += Counter()
        total = sum(counts.values(), Counter())
        share = lambda c: {t: 1 + scale * (c[t] + prior) // (sum(c.values()) + prior * len(kept)) for t in kept}
        shares, q = {s: share(counts[s]) for s in {d[1] for d in mine}}, share(total)
        for s, p in shares.items():
            pairs = [(-sum(abs(p[t] - o[t]) for t in kept), other) for other, o in shares.items() if other != s]
            best = sorted((-(p[t] - q[t]), t.encode()) for t in kept if counts[s][t] and p[t] > q[t])[:top]
            out += [(lang, s, "pair", item, -v, i) for i, (v, item) in enumerate(sorted(pairs, key=lambda x: (x[0], x[1].encode())), 1)]
            out += [(lang, s, "term", item.decode(), -v, i) for i, (v, item) in enumerate(best, 1)]
    return sorted(map(repr, out))


@pytest.mark.parametrize("flush, held", [(4, 1000), (1000, 9), (1000, 60)])
def test_divergence_by_hand(spark, monkeypatch, flush, held):
    """Terms beyond ASCII and longer than every level, null and blank groups, a group without terms, ties."""
    monkeypatch.setattr(source_divergence, "FLUSH", flush)
    monkeypatch.setattr(source_divergence, "HELD", held)
    monkeypatch.setattr(source_divergence, "CELLS", 16)
    monkeypatch.setattr(source_divergence, "STRIPE", 2)
    rng = random.Random(3)
    vocabulary = ["Alpha", "alpha", "alphabetically", "alphabetical", "überlang", "слово", "словоформа", "語" * 9, "é", "x", "prefix" * 5, "prefix" * 5 + "a"]
    data = [(rng.choice(["en", "en", "de", None, ""]), rng.choice(["a", "b", "c", None, "é"]),
             " ".join(rng.choices(vocabulary, k=rng.randrange(12))) + "!9_") for _ in range(160)]
    data += [("en", "silent", None), ("zz", "only", "rare words"), ("zz", "other", "")]
    frame = spark.createDataFrame(data, "lang string, source string, text string")
    got = source_divergence.divergence(frame, min_docs=6, top=4)
    assert rows(got) == divergence_by_hand(data, 6, 5, 10 ** 9, 4)


def test_divergence_equals_sql(spark, docs, empty):
    wanted = from_sql(source_divergence.SQL, docs.select("doc_id", "text", "lang", "source"))
    assert rows(source_divergence.divergence(docs)) == wanted
    assert source_divergence.divergence(empty).count() == 0


def test_refinement_discards_and_keeps(spark):
    """A prefix that enough documents share does not make its terms common."""
    data = [("en", "a", f"shared{i} common") for i in range(40)]
    frame = spark.createDataFrame(data, "lang string, source string, text string")
    kept = source_divergence.kept_terms(frame, 30).collect()
    # Digits end a term: 'shared' itself is in every document.
    assert sorted(r["term"] for r in kept) == ["common", "shared"]
    data = [("en", "a", "shared" + chr(97 + i % 26) + chr(97 + i // 26)) for i in range(40)]
    assert source_divergence.kept_terms(spark.createDataFrame(data, "lang string, source string, text string"), 30).count() == 0


# -- op12 --------------------------------------------------------------------------------
def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def variants_by_hand(data):
    n = Counter()
    for doc_id, text in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    out, forms, links = [], {}, {w: [v for v in n if near(w, v)] for w in n}
    for w in n:
        best = min(links[w], key=lambda v: (-n[v], v), default=None)
        forms[w] = best if best and n[best] >= 5 * n[w] else None
    for w in n:
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n[w], len(links[w]), n[forms[w]] if forms[w] else None))
    return sorted(map(repr, out))


@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefgh"])
def test_variants_by_hand(spark, monkeypatch, letters):
    """Words of few letters: repeated bigrams, all kinds of edits, chains of forms, ties."""
    monkeypatch.setattr(spelling_variants, "FLUSH", 30)
    monkeypatch.setattr(spelling_variants, "LOOK", 200)
    rng = random.Random(len(letters))
    words = list({"".join(rng.choices(letters, k=rng.choice([6, 6, 7, 8]))) for _ in range(60)})
    for w in words[:30]:
        i = rng.randrange(len(w))
        words += [w[:i] + w[i + 1:] + rng.choice(letters), w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]]
    weight = {w: rng.choice([5, 5, 6, 26, 30, 140, 700]) for w in words}
    bag = [w if rng.random() < .9 else w.upper() for w, k in weight.items() for _ in range(k)]
    rng.shuffle(bag)
    data = [(i // 50 if i % 7 else None, " ".join(bag[i:i + 50])) for i in range(0, len(bag), 50)] + [(1, None), (None, ""), (3, "÷× 12")]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(spelling_variants.variants(frame)) == variants_by_hand(data)


def test_pivots_are_the_best_disjoint_pair():
    rng = random.Random(5)
    for _ in range(200):
        prefix = [(rng.randrange(50), i) for i in sorted(rng.sample(range(12), rng.randrange(3, 7)))]
        got = spelling_variants.pivots(prefix)
        assert len(got) == 2 and abs(got[0][1] - got[1][1]) >= 2
        assert sum(g[0] for g in got) == min(a[0] + b[0] for a in prefix for b in prefix if b[1] - a[1] >= 2)


def test_variants_on_documents(spark, docs, empty):
    data = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert rows(spelling_variants.variants(docs)) == variants_by_hand(data)
    assert spelling_variants.variants(empty).count() == 0


def test_variants_query(spark):
    data = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(spelling_variants.op12_spelling_variants(spark, SF)) == variants_by_hand(data)


def test_terms_of_many_texts_are_counted_together(monkeypatch):
    """A term is looked up once for all its uses in a slice, a filter's prefix once for all its terms (F2)."""
    import pyarrow as pa
    texts = ["Éa b ab1AB\x00abc", "", "  ", "abcdef abcdeg ABCDEF", "日本　z ab ab", "x " * 50 + "abcdef"]
    column = pa.array([t.encode() for t in ["cut off", *texts]], pa.binary())[1:]
    found, codes, upto = source_divergence.terms(column)
    plain = [t.encode().translate(source_divergence._TERM_BYTES).split() for t in texts]
    words = [w.encode() for w in found.to_pylist()]
    assert [[words[c] for c in codes[a:b]] for a, b in zip(upto, upto[1:])] == plain
    assert len(words) == len(set(words))

    calls = []
    monkeypatch.setattr(source_divergence, "crc32", lambda x, seed=0: calls.append(x) or zlib.crc32(x, seed))
    bits = bytearray(source_divergence.SLOTS // 8)
    slot = zlib.crc32(b"abcde", zlib.crc32(b"en\0")) % source_divergence.SLOTS
    bits[slot >> 3] |= 1 << (slot & 7)
    number, prefixes = source_divergence._numbers("en", found, 6, (5, bytes(bits)))
    assert sorted(calls) == sorted({b"en\0"} | {w[:5] for w in words})
    assert {w for w, k in zip(words, number) if k >= 0} == {b"abcdef", b"abcdeg"}
    assert {prefixes[k].as_py() for k in number if k >= 0} == {b"abcdef", b"abcdeg"}

    place, source = np.repeat(np.arange(len(texts)), np.diff(upto)), np.array([0, 0, 1, 1, 0, 1])
    want = Counter((s, w) for s, p in zip(source.tolist(), plain) for w in p), Counter((s, w) for s, p in zip(source.tolist(), plain) for w in set(p))
    got = source_divergence._tally(codes, place, source, 2, len(words))
    assert {(s, words[k]): (n, d) for s, k, d, n in zip(*(x.tolist() for x in got))} == {k: (n, want[1][k]) for k, n in want[0].items()}
    assert all(np.array_equal(a, b) for a, b in zip(got, source_divergence._tally(codes, place, source, 1 << 22, len(words))))
    none = np.zeros(0, np.int64)
    assert [len(x) for x in source_divergence._tally(none, none, none, 1, 0)] == [0] * 4
