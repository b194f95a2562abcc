"""Language-model scoring: a causal self-attention model over subword ids, beside a word
unigram base, both learned from the training fold of the corpus.

Text: words (runs of other than ASCII white space, A-Z lower-cased), then one end.  Base:
add-one unigram over words.  Words are counted in the tasks and summed by Spark; the most
frequent (``FREQUENT`` words at most) are broadcast with their counts, all other words of a
document are joined with theirs, so no word is left out.

Model: ids of the words, each after a space, by a public byte-level BPE, then an end id.  Each text
is encoded once, and its ids are kept for the counts, the training and the scoring; pairs of an id
and the one before it, across word boundaries and from the start of a text to its end, are counted
over all training texts in a Spark aggregate.  The ids form ``CLASSES`` classes by their neighbours
in the texts, the classes ``GROUPS`` groups by theirs;
p(id) = p(group | context) * p(class | group, context) * p(id | class, previous id).  The logits of
the groups, and of the classes within a group, are a transition table (previous id's bucket to
group, and to class) plus one causal self-attention layer trained in numpy: of each id the groups
and the classes of its own group are computed, which give the probability exactly.
Buckets are the ``RANKS`` most frequent ids one by one and the others by class.  p(id | class,
previous id) counts every pair, in two tables of fixed size: one from the previous id's bucket
to slots (the ``EACH`` most frequent ids one by one, a class's others together), one from the
previous id's class to the ids that share a slot.  Both fall back to the frequency within the
class.  Attention weights are trained once on every
training document: each of ``ROUNDS`` rounds takes its share of the documents in all tasks at
once, and the tasks' weights are averaged by Spark between rounds.  Scoring: overlapping windows
of ``WINDOW`` inputs, every second half scored, so that each id is scored once with at least
half a window of context; windows of many documents go through batched masked attention
together.

Null and empty texts are the end alone.  Rows are scored one by one (repeats alike, extra
columns ignored).  A null doc_id counts as the empty text for the fold.  Without training
documents counts are zero and the classes uniform.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import coded_words, slices, stored, table
from tributary.llm.language_id import held_out
from tributary.llm.tokens import Encoder

FREQUENT = 1 << 18
VOCABULARY = 50_257
END = VOCABULARY - 1
CLASSES = 128
GROUPS = 8
MEMBERS = CLASSES // GROUPS
SINGLE = 32
NEAR = 64
RANKS = 4096
BUCKETS = RANKS + CLASSES
START, PAD = BUCKETS, BUCKETS + 1
WINDOW = 16
WIDTH = 16
HALF = WINDOW // 2
ROUNDS = 2
#: Most frequent ids with a slot of their own; all slots.
EACH = 1920
SLOTS = EACH + CLASSES
#: Weight of the frequency within the class against counted pairs.
FALL_BACK = 5.0
RATE = 1.5e-2
#: Ids handled at once; bytes of text handled at once; windows in one step of training, in one
#: batch of scoring; rows in one product; words remembered per worker; words that a task counts
#: before it gives them on.
AT_ONCE = 1 << 18
TEXT = 4 << 20
STEP = 512
BATCH = 512
ROWS = 512
REMEMBER = 150_000
FLUSH = 1_000_000


# -- splitting words into ids ----------------------------------------------------------------
#: One per worker process, not one per task.
_encoder = cache(Encoder)


#: White space of the encoder's pattern, not ASCII, on both sides of a space.
_WHITE = "[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_SPACES = re.compile(f"{_WHITE} {_WHITE}")
_END = np.array([END], np.int32)


class Words(dict):
    """Word (bytes) -> number, with the ids of each word in growing arrays."""

    def __init__(self, tokenizer: str | None = None):
        super().__init__()
        self.encode = _encoder(tokenizer).plain.encode_ordinary
        self.flat, self.start, self.size = array("q"), array("q"), array("q")

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.size)
        ids = self.encode(" " + word.decode("utf-8", "replace"))
        self.start.append(len(self.flat))
        self.size.append(len(ids))
        self.flat.extend(ids)
        return n

    def _forget(self) -> None:
        """Drops the words met last; frequent ones are met early."""
        left = REMEMBER // 2
        for word in list(islice(reversed(self), len(self) - left)):
            del self[word]
        del self.flat[self.start[left]:]
        del self.start[left:], self.size[left:]

    def ids(self, text: list[bytes]) -> np.ndarray:
        """The ids of all words of a text."""
        if not text:
            return np.array([], np.int64)
        if len(self) > REMEMBER:
            self._forget()
        numbers = np.fromiter(map(self.__getitem__, text), np.int64, len(text))
        start, size, flat = (np.frombuffer(x, np.int64) for x in (self.start, self.size, self.flat))
        size = size[numbers]
        upto = np.cumsum(size)
        return flat[np.arange(upto[-1]) + np.repeat(start[numbers] - upto + size, size)]


@cache
def worker_words() -> Words:
    """One per worker process, so that later texts know the words of earlier ones."""
    return Words()


def words_of(column: pa.Array) -> Iterator[tuple[slice, pa.Array, np.ndarray, np.ndarray]]:
    """For some texts of a column at once: which, and their ``coded_words`` with A-Z lower-cased."""
    for some in slices(column, TEXT):
        yield some, *coded_words(pc.ascii_lower(column[some]))


def ids_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts, one text after another, an end after each; where each begins, and the length
    of all.  A text is encoded at once, its words parted by one space, which gives the ids that its
    words have one by one; texts with other white space on both sides of a space go by words."""
    encode, known, parts = _encoder(None).plain.encode_ordinary, worker_words(), []
    for t in texts.cast(pa.binary()):
        words = (t.as_py() or b"").lower().split()
        line = b" ".join([b"", *words]).decode("utf-8", "replace")
        by_word = not line.isascii() and _SPACES.search(line)
        parts.append(known.ids(words).astype(np.int32) if by_word else np.array(encode(line), np.int32))
        parts.append(_END)
    sizes = np.array([len(x) for x in parts[::2]], np.int64) + 1
    return np.concatenate([np.array([], np.int32), *parts]), np.append(0, np.cumsum(sizes))


def packed(ids: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The ids of each text as bytes, two to an id."""
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer((2 * starts).astype(np.int32)), pa.py_buffer(ids.astype("<u2"))])


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts, listed or ``packed``, one text after another; where each begins, and the length of all."""
    if not pa.types.is_binary(column.type):
        return column.flatten().to_numpy(), np.append(0, np.cumsum(column.value_lengths().to_numpy(), dtype=np.int64))
    _, upto, ids = column.buffers()
    upto = np.frombuffer(upto, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(ids or b"", np.uint8)[upto[0]:upto[-1]].view("<u2"), (upto - upto[0]) // 2


# -- counts ----------------------------------------------------------------------------------
def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) of lower-cased words; the end is not among them."""
    def merged(held: list[pa.Table]) -> list[pa.RecordBatch]:
        sums = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum")])
        return sums.select(["word", "c_sum"]).rename_columns(["word", "c"]).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for b in batches:
            for _, distinct, codes, _ in words_of(b.column(0)):
                held.append(pa.table({"word": distinct, "c": np.bincount(codes, minlength=len(distinct))}))
                if sum(map(len, held)) >= FLUSH:
                    yield from merged(held)
                    held = []
        if held:
            yield from merged(held)
    return docs.select("text").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def frequent_words(counts: DataFrame) -> pa.Table:
    """The most frequent words with their counts, ``FREQUENT`` at most: all words of the least
    count that leaves no more."""
    most, words = 0, 0
    for r in counts.groupBy("c").agg(F.count("*").alias("words")).orderBy(F.col("c").desc()).toLocalIterator():
        words += r["words"]
        if words > FREQUENT:
            break
        most = r["c"]
    top = counts.filter(F.col("c") >= most) if most else counts.limit(0)
    return top.toArrow().combine_chunks()


def split_texts(docs: DataFrame) -> DataFrame:
    """(round, ids) of each training text, written once for the counts and the training."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in slices(b.column(1), TEXT):
                ids, starts = ids_of(b.column(1)[some])
                ids = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([b.column(0)[some], ids], names=["round", "ids"])
    return stored(docs.sparkSession, docs.select(_round().alias("round"), "text").mapInArrow(run, "round int, ids array<int>"), "text-ids")


def _round() -> Column:
    """The round in which a text is trained on."""
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)).cast("int")


def count_pairs(texts: DataFrame) -> DataFrame:
    """(prev, next, c): how often an id follows another; ``VOCABULARY`` stands before a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
            found, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return found, np.bincount(at, np.concatenate([c for _, c in parts])).astype(np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            ids, starts = unpacked(b.column(0))
            starts = starts[:-1]
            for at in range(0, len(ids), AT_ONCE):
                here = ids[at:at + AT_ONCE].astype(np.int64)
                before = np.empty_like(here)
                before[1:], before[0] = here[:-1], ids[at - 1]
                before[starts[np.searchsorted(starts, at):np.searchsorted(starts, at + len(here))] - at] = VOCABULARY
                parts.append(np.unique(before * VOCABULARY + here, return_counts=True))
                if sum(len(k) for k, _ in parts) > 4 * AT_ONCE:
                    parts = [merged(parts)]
                    if len(parts[0][0]) > 2 * AT_ONCE:
                        yield batch(*parts.pop())
        if parts:
            yield batch(*merged(parts))

    def batch(keys: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys // VOCABULARY, pa.int32()), pa.array(keys % VOCABULARY, pa.int32()),
                                           pa.array(c, pa.int64())], names=["prev", "next", "c"])
    rows = texts.select("ids").mapInArrow(run, "prev int, next int, c long")
    return stored(texts.sparkSession, rows.groupBy("prev", "next").agg(F.sum("c").alias("c")), "id-pairs")


def _sums(pairs: DataFrame, of, width: int) -> np.ndarray:
    """Summed over all pairs: the vector (of ``width``) that ``of`` makes of ids and counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for b in batches:
            of(total, *(b.column(k).to_numpy().astype(np.int64) for k in range(3)))
        at = np.flatnonzero(total)
        for k in range(0, len(at), 100_000):
            part = at[k:k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(total[part], pa.int64())], names=["k", "v"])
    rows = pairs.mapInArrow(run, "k long, v long").groupBy("k").agg(F.sum("v").alias("v"))
    out = np.zeros(width, np.int64)
    for b in rows.toArrow().to_batches():  # at most ``width`` numbers
        out[b.column(0).to_numpy()] = b.column(1).to_numpy()
    return out


def _count_ids(total: np.ndarray, prev: np.ndarray, ids: np.ndarray, c: np.ndarray) -> None:
    np.add.at(total, ids, c)


def _count_neighbours(rank: np.ndarray):
    """For ``_sums``: (id, side, neighbour in a text), neighbours beyond ``NEAR`` as one."""
    near = np.minimum(rank, NEAR)

    def run(total: np.ndarray, prev: np.ndarray, ids: np.ndarray, c: np.ndarray) -> None:
        i = prev < VOCABULARY
        np.add.at(total, prev[i] * 2 * (NEAR + 1) + near[ids[i]], c[i])
        np.add.at(total, ids[i] * 2 * (NEAR + 1) + NEAR + 1 + near[prev[i]], c[i])
    return run


def classes(counts: np.ndarray, neighbours: np.ndarray) -> np.ndarray:
    """A class for each id: the most frequent ids are classes of their own, the others are
    grouped by their neighbours (spherical k-means); unseen ids share the last."""
    order = np.argsort(-counts, kind="stable")
    cls = np.full(VOCABULARY, CLASSES - 1, np.int64)
    cls[order[:SINGLE]] = np.arange(SINGLE)
    rest = order[SINGLE:][counts[order[SINGLE:]] > 0]
    if len(rest):
        f = np.sqrt(neighbours.reshape(VOCABULARY, -1)[rest]).astype(np.float32)
        f /= np.linalg.norm(f, axis=1, keepdims=True) + 1e-9
        mass, centre = counts[rest][:, None].astype(np.float32), f[:CLASSES - SINGLE - 1].copy()
        for _ in range(12):
            own = (f @ centre.T).argmax(axis=1)
            for j in range(len(centre)):
                if (m := own == j).any():
                    centre[j] = (f[m] * mass[m]).sum(axis=0)
                    centre[j] /= np.linalg.norm(centre[j]) + 1e-9
        cls[rest] = SINGLE + own
    seen = np.flatnonzero(counts)
    near = np.zeros((CLASSES, neighbours.size // VOCABULARY))
    np.add.at(near, cls[seen], neighbours.reshape(VOCABULARY, -1)[seen])
    return grouped(near)[cls]


def grouped(neighbours: np.ndarray) -> np.ndarray:
    """New numbers of classes, so that each group is classes with like neighbours: halved along
    the widest spread of their shares, until the halves are groups."""
    share = np.sqrt(neighbours)
    share /= np.linalg.norm(share, axis=1, keepdims=True) + 1e-9

    def halved(own: np.ndarray) -> np.ndarray:
        if len(own) <= MEMBERS:
            return own
        apart = share[own] - share[own].mean(axis=0)
        along = apart @ np.linalg.svd(apart, full_matrices=False)[2][0]
        own = own[np.argsort(along, kind="stable")]
        return np.concatenate([halved(own[:len(own) // 2]), halved(own[len(own) // 2:])])
    return np.argsort(halved(np.arange(CLASSES)))


class Model:
    """Classes, tables and weights.  ``MEMBERS`` classes in a row are a group."""

    def __init__(self, id_counts: np.ndarray, rank: np.ndarray, cls: np.ndarray):
        self.counts, self.cls = id_counts, cls
        self.bucket = np.where(rank < RANKS, rank, RANKS + cls)
        smooth = id_counts + 0.1
        self.within = np.log(smooth / np.bincount(self.cls, smooth, CLASSES)[self.cls])
        # by bucket and group: logits of the groups, then of the group's classes
        self.table = np.zeros((BUCKETS + 2, GROUPS, GROUPS + MEMBERS), np.float32)
        self.slot = np.where(rank < EACH, rank, EACH + cls)
        self.near = self.far = None
        # the class of each bucket, the start's last
        self.group = np.full(BUCKETS + 2, CLASSES)
        self.group[self.bucket] = cls
        rng = np.random.default_rng(11)
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.w = {"e": (rng.standard_normal((BUCKETS + 2, WIDTH)) * 0.3).astype(np.float32), "p": draw(WINDOW, WIDTH) * 0.3,
                  "q": draw(WIDTH, WIDTH), "k": draw(WIDTH, WIDTH), "v": draw(WIDTH, WIDTH), "o": draw(WIDTH, CLASSES) * 0.1, "g": draw(WIDTH, GROUPS) * 0.1}

    def count_transitions(self, bucket, cls):
        """For ``_sums``: (bucket of the id before, class), the start's bucket last."""
        bucket = np.append(bucket, START)

        def run(total, prev, ids, c):
            np.add.at(total, bucket[prev] * CLASSES + cls[ids], c)
        return run

    def set_transitions(self, sums: np.ndarray) -> None:
        base = np.bincount(self.cls, self.counts + 0.1, CLASSES) + 1e-3
        rows = (sums.reshape(BUCKETS + 1, CLASSES) + 5 * base / base.sum()).reshape(-1, GROUPS, MEMBERS)
        groups = rows.sum(axis=2)
        self.table[:START + 1, :, :GROUPS] = np.log(groups / groups.sum(axis=1, keepdims=True))[:, None, :]
        self.table[:START + 1, :, GROUPS:] = np.log(rows / groups[:, :, None])
        self.table[PAD] = self.table[START]

    def outputs(self) -> np.ndarray:
        """Weights from the layer to the logits, by group: of all groups, then of the group's classes."""
        classes = self.w["o"].reshape(WIDTH, GROUPS, MEMBERS).transpose(1, 0, 2)
        return np.concatenate([np.broadcast_to(self.w["g"], (GROUPS, WIDTH, GROUPS)), classes], axis=2)

    def count_slots(self, total: np.ndarray, prev: np.ndarray, ids: np.ndarray, c: np.ndarray) -> None:
        """For ``_sums``: (bucket of the id before, slot), the start's bucket last."""
        np.add.at(total, np.append(self.bucket, START)[prev] * SLOTS + self.slot[ids], c)

    def count_shared(self, total: np.ndarray, prev: np.ndarray, ids: np.ndarray, c: np.ndarray) -> None:
        """For ``_sums``: (class of the id before, id) of ids that share a slot, the start's class last."""
        i = self.slot[ids] >= EACH
        np.add.at(total, np.append(self.cls, CLASSES)[prev[i]] * VOCABULARY + ids[i], c[i])

    def set_within(self, slots: np.ndarray, shared: np.ndarray) -> None:
        """p(id | class, previous id) of all pairs' sums: the slot by the bucket before (``near``),
        then the id among those that share the slot by the class before (``far``)."""
        among = np.empty(SLOTS, np.int64)
        among[self.slot] = self.cls
        among[EACH:] = np.arange(CLASSES)
        mass = np.bincount(self.slot, np.exp(self.within), SLOTS)
        self.near = _smoothed(slots.reshape(-1, SLOTS), mass, among)
        rest = np.flatnonzero(self.slot >= EACH)
        own = np.exp(self.within[rest]) / mass[self.slot[rest]]
        self.far = np.zeros((CLASSES + 1, VOCABULARY), np.float32)
        self.far[:, rest] = _smoothed(shared.reshape(-1, VOCABULARY)[:, rest], own, self.cls[rest])

    def set_pairs(self, prev: np.ndarray, ids: np.ndarray, c: np.ndarray) -> None:
        """``set_within`` of the given pairs alone."""
        slots, shared = np.zeros((BUCKETS + 1) * SLOTS, np.int64), np.zeros((CLASSES + 1) * VOCABULARY, np.int64)
        self.count_slots(slots, prev, ids, c)
        self.count_shared(shared, prev, ids, c)
        self.set_within(slots, shared)

    def within_class(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Natural log p(id | class, bucket of the id before); ``before`` may not be padding."""
        if self.near is None:
            return self.within[ids]
        out = self.near.ravel()[before * SLOTS + self.slot[ids]]
        shared = np.flatnonzero(self.slot[ids] >= EACH)
        out[shared] += self.far.ravel()[self.group[before[shared]] * VOCABULARY + ids[shared]]
        return out


def _smoothed(counts: np.ndarray, own: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Log shares within its class of each column, by rows; ``own`` are the shares to fall back to."""
    out = np.empty(counts.shape, np.float32)
    with np.errstate(divide="ignore"):  # an empty slot has no share
        for row in range(len(counts)):
            sums = np.bincount(cls, counts[row], CLASSES) + FALL_BACK
            out[row] = np.log((counts[row] + FALL_BACK * own) / sums[cls])
    return out


# -- windows and the network ---------------------------------------------------------------
def windows(ids: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Inputs (blocks, WINDOW) and targets (blocks, HALF; -1 beyond the end) of one text."""
    blocks = -(-len(ids) // HALF)
    x = np.full((blocks + 1) * HALF, PAD, np.int64)
    x[HALF] = START
    x[HALF + 1:HALF + len(ids)] = model.bucket[ids[:-1]]
    y = np.full(blocks * HALF, -1, np.int64)
    y[:len(ids)] = ids
    x = x.reshape(-1, HALF)
    return np.concatenate([x[:-1], x[1:]], axis=1), y.reshape(-1, HALF)


_CAUSAL = (np.arange(WINDOW)[None, :] <= HALF + np.arange(HALF)[:, None]).astype(np.float32)


def log_probabilities(model: Model, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Natural log probabilities of the targets (0 beyond the end)."""
    out = np.zeros(y.shape)
    w, scale = model.w, np.float32(1 / np.sqrt(WIDTH))
    eq, ekv = w["e"] @ w["q"] * scale, w["e"] @ np.concatenate([w["k"], w["v"]], axis=1)
    pq, pkv = w["p"][HALF:] @ w["q"] * scale, w["p"] @ np.concatenate([w["k"], w["v"]], axis=1)
    own, table = model.outputs(), model.table.reshape(-1, GROUPS + MEMBERS)
    for at in range(0, len(x), BATCH):
        xs, ys = x[at:at + BATCH], y[at:at + BATCH].ravel()
        here = xs[:, HALF:]
        kv = np.take(ekv, xs, axis=0)
        kv += pkv
        q = np.take(eq, here, axis=0)
        q += pq
        s = q @ kv[:, :, :WIDTH].transpose(0, 2, 1)
        np.exp(np.minimum(s, 60, out=s), out=s)
        s *= _CAUSAL
        if (pad := xs == PAD).any():
            s *= ~pad[:, None, :]
        h = s @ kv[:, :, WIDTH:]
        h /= (s @ _ONES)[:, :, None]
        h += np.take(w["e"], here, axis=0)
        here = here.ravel()
        cls = model.cls[ys]
        order, group, stretches = by_group(cls)
        h = np.take(h.reshape(-1, WIDTH), order, axis=0)
        z = np.take(table, np.take(here, order) * GROUPS + group, axis=0)
        for g, part in stretches:
            z[part] += h[part] @ own[g]
        row, each = np.arange(len(z)) * (GROUPS + MEMBERS), z.ravel()
        got = each[row + group] + each[row + GROUPS + np.take(cls, order) % MEMBERS]
        got -= np.log(np.exp(z, out=z) @ _PARTS).sum(axis=1)
        ends = ys < 0
        score = model.within_class(np.where(ends, START, here), ys)
        score[order] += got
        score[ends] = 0
        out[at:at + BATCH] = score.reshape(-1, HALF)
    return out


def by_group(cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, slice]]]:
    """Of the classes of targets: their order by group, the groups in that order, and each group's stretch of it."""
    group = (cls // MEMBERS).astype(np.uint8)
    order = np.argsort(group, kind="stable")
    upto = np.cumsum(np.bincount(group, minlength=GROUPS)).tolist()
    return order, np.take(group, order), [(g, slice(a, b)) for g, (a, b) in enumerate(zip([0, *upto], upto)) if a < b]


#: Sums the logits of the groups and of the classes apart.
_PARTS = np.repeat(np.eye(2, dtype=np.float32), [GROUPS, MEMBERS], axis=0)
_ONES = np.ones(WINDOW, np.float32)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a.T @ b of many rows, ``ROWS`` at once."""
    whole = len(a) // ROWS * ROWS
    out = a[whole:].T @ b[whole:]
    if whole:
        out += (a[:whole].reshape(-1, ROWS, a.shape[1]).transpose(0, 2, 1) @ b[:whole].reshape(-1, ROWS, b.shape[1])).sum(axis=0)
    return out


def gradients(model: Model, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy of the classes and its gradient."""
    w, scale = model.w, np.float32(1 / np.sqrt(WIDTH))
    flat = lambda t: t.reshape(-1, t.shape[-1])
    by_window = lambda t: t.reshape(len(x), -1, t.shape[-1])
    y = y.ravel()
    real = y >= 0
    n = max(int(np.count_nonzero(real)), 1)
    z = np.take(w["e"], x, axis=0)
    eq = z[:, HALF:].copy()
    z += w["p"]
    zq, z = flat(z[:, HALF:]), flat(z)
    wkv = np.concatenate([w["k"], w["v"]], axis=1)
    q, kv = by_window(zq @ (w["q"] * scale)), by_window(z @ wkv)
    k, v = kv[:, :, :WIDTH], kv[:, :, WIDTH:]
    a = q @ k.transpose(0, 2, 1)
    np.exp(np.minimum(a, 60, out=a), out=a)
    a *= _CAUSAL
    if (pad := x == PAD).any():
        a *= ~pad[:, None, :]
    a /= (a @ _ONES)[:, :, None]
    h = a @ v
    h += eq

    # from here the targets are in the order of their groups
    cls = model.cls[y]
    order, group, stretches = by_group(cls)
    h, out = np.take(flat(h), order, axis=0), model.outputs()
    p = np.take(model.table.reshape(-1, GROUPS + MEMBERS), np.take(x[:, HALF:].ravel(), order) * GROUPS + group, axis=0)
    for g, at in stretches:
        p[at] += h[at] @ out[g]
    row = np.arange(len(p)) * (GROUPS + MEMBERS)
    hot_group, hot_class = row + group, row + GROUPS + np.take(cls, order) % MEMBERS
    each = p.ravel()
    got = each[hot_group] + each[hot_class]
    np.exp(np.minimum(p, 80, out=p), out=p)
    sums = p @ _PARTS
    weight = np.take(real, order) / np.float32(n)
    loss = -float(((got - np.log(sums).sum(axis=1)) * weight).sum())
    p *= (weight[:, None] / sums) @ _PARTS.T
    each[hot_group] -= weight
    each[hot_class] -= weight
    g_out, dh = np.zeros(out.shape, np.float32), np.empty_like(h)
    for g, at in stretches:
        g_out[g] = h[at].T @ p[at]
        dh[order[at]] = p[at] @ out[g].T
    grad = {"g": g_out[:, :, :GROUPS].sum(axis=0), "o": g_out[:, :, GROUPS:].transpose(1, 0, 2).reshape(WIDTH, CLASSES)}

    dh = by_window(dh)
    da = dh @ v.transpose(0, 2, 1)
    da *= a
    da -= a * (da @ _ONES)[:, :, None]
    dkv = np.empty_like(kv)
    np.matmul(da.transpose(0, 2, 1), q, out=dkv[:, :, :WIDTH])
    np.matmul(a.transpose(0, 2, 1), dh, out=dkv[:, :, WIDTH:])
    dkv, dq = flat(dkv), flat(da @ k)
    dq *= scale
    grad["q"], g_kv = _products(zq, dq), _products(z, dkv)
    grad["k"], grad["v"] = g_kv[:, :WIDTH], g_kv[:, WIDTH:]
    dz = by_window(dkv @ wkv.T)
    dz[:, HALF:] += by_window(dq @ w["q"].T)
    grad["p"] = dz.sum(axis=0)
    dz[:, HALF:] += dh
    bucket = x.ravel().astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    bucket = np.take(bucket, order)
    starts = np.append(0, np.flatnonzero(bucket[1:] != bucket[:-1]) + 1)
    grad["e"] = np.zeros_like(w["e"])
    # two floats at once, as the parts of a complex number
    sums = np.add.reduceat(np.take(flat(dz), order, axis=0).astype(np.float32, copy=False).view(np.complex64), starts, axis=0)
    grad["e"][bucket[starts]] = sums.view(np.float32)
    return loss, grad


def adam(weights: np.ndarray, m: np.ndarray, v: np.ndarray, gradient: np.ndarray, step: int) -> None:
    """One step, in place; ``gradient`` serves as scratch space."""
    rate = RATE * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
    m *= np.float32(0.9)
    m += np.float32(0.1) * gradient
    v *= np.float32(0.999)
    gradient *= gradient
    gradient *= np.float32(0.001)
    v += gradient
    by = np.sqrt(v, out=gradient)
    by += np.float32(1e-8)
    change = np.divide(m, by, out=by)
    change *= np.float32(rate)
    weights -= change


def train_round(texts: DataFrame, model: Model, round_: int) -> None:
    """Every task trains from the same weights on its texts; the results are averaged."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(model)
    names = sorted(model.w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        # one vector of all weights, of which each is a view
        flat = np.concatenate([model.w[k].ravel() for k in names])
        ends = np.cumsum([model.w[k].size for k in names])
        model.w = {k: part.reshape(model.w[k].shape) for k, part in zip(names, np.split(flat, ends[:-1]))}
        m, v = np.zeros_like(flat), np.zeros_like(flat)
        step = seen = 0
        held: list[tuple[np.ndarray, np.ndarray]] = []
        blocks = 0

        def learn() -> None:
            nonlocal step, seen
            x, y = (np.concatenate(z) for z in zip(*held))
            order = np.random.default_rng(round_).permutation(len(x))
            for at in range(0, len(x), STEP):
                ids = order[at:at + STEP]
                _, g = gradients(model, np.take(x, ids, axis=0), np.take(y, ids, axis=0))
                step += 1
                seen += len(ids)
                adam(flat, m, v, np.concatenate([g[k].ravel() for k in names], dtype=np.float32), step)
        for b in batches:
            ids, starts = unpacked(b.column(0))
            for at, end in pairwise(starts.tolist()):
                held.append(windows(ids[at:end], model))
                blocks += len(held[-1][0])
                if blocks > 8192:
                    learn()
                    held, blocks = [], 0
        if held:
            learn()
        if seen:
            own = np.append(flat.astype(float) * seen, seen)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(own)), pa.int64()), pa.array(own, pa.float64())], names=["k", "v"])
    chosen = texts.filter(F.col("round") == round_).select("ids")
    rows = chosen.mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v"))
    flat = np.zeros(sum(model.w[k].size for k in names) + 1)
    for b in rows.toArrow().to_batches():
        flat[b.column(0).to_numpy()] = b.column(1).to_numpy()
    if flat[-1] > 0:
        at = 0
        for k in names:
            size = model.w[k].size
            model.w[k] = (flat[at:at + size] / flat[-1]).reshape(model.w[k].shape).astype(np.float32)
            at += size


def train(docs: DataFrame) -> Model:
    """The model of training texts ``docs`` (doc_id, text)."""
    return fit(split_texts(docs))


def fit(texts: DataFrame) -> Model:
    """The model of training texts (round, ids; ids listed or ``packed``)."""
    pairs = count_pairs(texts)
    ids = _sums(pairs, _count_ids, VOCABULARY)
    rank = np.empty(VOCABULARY, np.int64)
    rank[np.argsort(-ids, kind="stable")] = np.arange(VOCABULARY)
    neighbours = _sums(pairs, _count_neighbours(rank), VOCABULARY * 2 * (NEAR + 1))
    model = Model(ids, rank, classes(ids, neighbours))
    model.set_transitions(_sums(pairs, model.count_transitions(model.bucket, model.cls), (BUCKETS + 1) * CLASSES))
    for k in range(ROUNDS):
        train_round(texts, model, k)
    model.set_within(_sums(pairs, model.count_slots, (BUCKETS + 1) * SLOTS), _sums(pairs, model.count_shared, (CLASSES + 1) * VOCABULARY))
    return model


def scores_of(model: Model, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Log10 probability of each text, by ids of texts one after another."""
    out, at = np.empty(len(starts) - 1), 0
    while at < len(out):
        # about ``AT_ONCE`` ids, one text at least
        upto = max(at + 1, int(np.searchsorted(starts, starts[at] + AT_ONCE, "right")) - 1)
        x, y = zip(*(windows(ids[starts[k]:starts[k + 1]], model) for k in range(at, upto)))
        per_block = log_probabilities(model, np.concatenate(x), np.concatenate(y)).sum(axis=1)
        sizes = np.array([len(blocks) for blocks in x])
        out[at:upto] = np.add.reduceat(per_block, np.cumsum(sizes) - sizes) / np.log(10)
        at = upto
    return out


def score(docs: DataFrame, training) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row;
    rows for which the column ``training`` holds are learned from."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", training.alias("training"))
    learned = rows.filter("training").select("doc_id", "text")
    counts = stored(spark, word_counts(learned), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    texts = learned.count()
    n, v = total + texts, distinct + (texts > 0)
    frequent = spark.sparkContext.broadcast(frequent_words(counts))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequent.value
        count = np.append(often.column("c").to_numpy(), 0)
        task, row = TaskContext.get().partitionId(), 0
        end = np.log10((texts + 1) / (n + v + 1))
        for b in batches:
            for some, distinct, codes, upto in words_of(b.column(2)):
                # the base: words by their counts; those not among the frequent go on, counted by text
                at = pc.fill_null(pc.index_in(distinct, value_set=often.column("word").cast(distinct.type)), len(often))
                c = count[at.to_numpy(zero_copy_only=False)]
                size, sizes = len(upto) - 1, np.diff(upto)
                text = np.repeat(np.arange(size), sizes)
                base = np.bincount(text, np.where(c > 0, np.log10((c + 1) / (n + v + 1)), 0)[codes], size) + end
                common = (c > 0)[codes]
                known = np.bincount(text[common], minlength=size) + (texts > 0)
                rare, times = np.unique(text[~common] * np.int64(max(len(distinct), 1)) + codes[~common], return_counts=True)
                text, word = np.divmod(rare, max(len(distinct), 1))
                rare = pa.StructArray.from_arrays([distinct.take(pa.array(word)), pa.array(times, pa.int64())], names=["word", "n"])
                rare = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(size + 1)), pa.int32()), rare)
                rows = (np.int64(task) << 40) + row + np.arange(size)
                row += size
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), b.column(0)[some], b.column(1)[some], pa.array(sizes + 1, pa.int64()), pa.array(known, pa.int64()),
                     pa.array(base), rare, packed(*ids_of(b.column(2)[some]))], names=[x.split()[0] for x in schema.split(", ")])
    schema = ("row long, doc_id long, round int, n_tokens long, known long, base double, "
              "rare array<struct<word:string,n:long>>, ids binary")
    # the row numbers hold for this written table only
    rows = rows.select(F.col("doc_id").cast("long"), F.when(F.col("training"), _round()).alias("round"), "text")
    rows = stored(spark, rows.mapInArrow(read, schema), "text-ids")
    model = spark.sparkContext.broadcast(fit(rows.filter("round is not null").select("round", "ids")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = scores_of(model.value, *unpacked(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores)], names=["row", "score"])
    scored = stored(spark, rows.select("row", "ids").mapInArrow(run, "row long, score double"), "scores")
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n")
    logp = F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(n + v + 1)))
    found = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("n") * logp).alias("rare_base"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"))
    return rows.drop("rare", "ids").join(scored, "row").join(found, "row", "left").select(
        "doc_id", F.col("round").isNull().alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"), "score")


def op7_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score(docs, ~held_out(F.col("doc_id"), 7))
