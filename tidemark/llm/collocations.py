"""Phrase collocation mining by counting in the slots of minimal perfect hashes.

Texts become streams of word numbers, once. Then, for phrases of 2 to 5 words: only phrases whose
both parts one word shorter are frequent can be frequent themselves (Apriori). Mappers count such
phrases by hash into a small table of counters; the tables are summed in a tree, and a counter
below the threshold rules out all its phrases. What is left are the candidates. They get slots by a
minimal perfect hash, with the phrases stored beside it; mappers count occurrences into a numpy
array by slot, after a comparison with the stored phrase, and the arrays are summed in a tree. After
each length, streams are cut down to the places where a longer phrase may begin. A candidate's
score is read from the counts of its cuts, by slot.

Counts are exact: counters and hashes only rule out, stored phrases decide. Nothing grows in a task but
tables of candidates: 4 bytes a word of a phrase, some bits for the hash, and a count. There are
fewer than (words / 100) phrases of a length that are frequent, and few candidates beyond them.

Defined results: a null text is empty; a null language is `und`; empty tables and texts without
words give nothing; repeated rows count each for itself; a very long text is split into words
whole; ties in the report are broken by count, then by the phrase; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, small_batches

LEAST, LONGEST, TOP, FACTOR = 100, 5, 2_000, 1_000
#: Words that a mapper gathers before it looks at them, and words of a stream's row, which ends between
#: pieces: readers hold thousands of rows at a time.
GATHER, ROW_WORDS = 1 << 18, 1 << 12
#: Counters that rule out: one for so many words, between these powers of two.
WORDS_A_COUNTER, LEAST_BITS, MOST_BITS = 32, 12, 24
#: Counters of an array that travel together, and arrays that a node of the tree sums.
CHUNK, FAN_IN = 1 << 16, 32
#: Each wave of tasks that name candidates is so many times the one before.
WAVES = 8
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[65:91] += 32  # A-Z in lower case
_BYTES[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 10  # ends of pieces
_BYTES[9] = 32


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and for each the number of its piece."""
    texts = pa.concat_arrays([texts]) if texts.offset else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32)[: len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    data = _BYTES[raw]
    inside = (data != 32) & (data != 10)
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets - offsets[0]] = True  # a text begins, and so do a word and a piece
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | begins[:-1]))
    piece = np.cumsum((data == 10).astype(np.int32) + begins[:-1])[starts]
    kept = np.cumsum(inside)
    ends = np.concatenate([kept[starts] - 1, kept[-1:]]) if len(starts) else np.zeros(1, np.int64)
    out = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[inside]))
    return out, piece


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
    """(language, words, pieces), of some GATHER words of a language at a time."""
    held: dict[str, list] = {}
    sizes: dict[str, int] = {}

    def flush(lang: str) -> tuple[str, pa.Array, np.ndarray]:
        parts, last, pieces = held.pop(lang), 0, []
        for _, p in parts:
            pieces.append(p + last)
            last = pieces[-1][-1] + 1
        sizes.pop(lang)
        return lang, pa.concat_arrays([w for w, _ in parts]), np.concatenate(pieces)

    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            words, piece = _words(batch.column("text").filter(pc.equal(langs.indices, code)))
            if len(words):
                held.setdefault(lang, []).append((words, piece.astype(np.int64)))
                sizes[lang] = sizes.get(lang, 0) + len(words)
                if sizes[lang] >= GATHER:
                    yield flush(lang)
        while sum(sizes.values()) >= 8 * GATHER:  # many languages
            yield flush(max(sizes, key=sizes.get))
    for lang in list(held):
        yield flush(lang)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, words, _ in _gathered(batches):
        counts = words.value_counts()
        yield pa.record_batch({"lang": pa.array([lang] * len(counts), pa.string()), "word": counts.field(0).cast(pa.string()), "f": counts.field(1)})


def _mix(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    h = (h ^ word.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def phrase_hash(phrases: list[np.ndarray], seed: int) -> np.ndarray:
    """64 bits of each phrase; phrases[i] are the i-th words."""
    h = np.full(len(phrases[0]), (seed * 0xD1B54A32D192ED03 + 1) % 2**64, np.uint64)
    for w in phrases:
        h = _mix(h, w)
    return h


class Slots:
    """A minimal perfect hash over phrases of one length, with the phrases and their counts by slot.

    Level by level, the keys that no other one shares a place with take that place's bit; the others go on
    to the next level. A slot is the number of bits set before."""

    GAMMA = 2

    def __init__(self, phrases: np.ndarray):
        n, self.seed = len(phrases), 0
        while len(np.unique(hashes := phrase_hash(list(phrases.T), self.seed))) < n:
            self.seed += 1
        self.levels, rest, done = [], hashes, 0
        while len(rest):
            size = self.GAMMA * len(rest) + 61
            at = self._place(rest, len(self.levels), size)
            times = np.bincount(at, minlength=size)
            bits = times == 1
            self.levels.append((bits, np.cumsum(bits, dtype=np.int32) - 1 + done))
            done += int(bits.sum())
            rest = rest[~bits[at]]
        self.counts = np.zeros(n, np.int64)
        self.stored = np.empty_like(phrases)
        self.stored[self._slots(hashes)] = phrases

    @staticmethod
    def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        return (_mix(hashes, np.uint64([0xA0761D6478BD642F * (level + 1) % 2**64])) % np.uint64(size)).astype(np.int64)

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for level, (bits, rank) in enumerate(self.levels):
            at = self._place(hashes[open_], level, len(bits))
            hit = bits[at]
            out[open_[hit]] = rank[at[hit]]
            open_ = open_[~hit]
        return out

    def find(self, phrases: list[np.ndarray]) -> np.ndarray:
        """The slot of each phrase; -1: it is none of the stored ones."""
        if not len(self.stored):
            return np.full(len(phrases[0]), -1, np.int64)
        slots = self._slots(phrase_hash(phrases, self.seed))
        same = slots >= 0
        for i, w in enumerate(phrases):
            same &= self.stored[slots, i] == w
        return np.where(same, slots, -1)


def _windows(ids: np.ndarray, k: int) -> np.ndarray:
    """Where k words follow each other in a stream."""
    if len(ids) < k:
        return np.zeros(0, np.int64)
    whole = ids[: len(ids) - k + 1] >= 0
    for i in range(1, k):
        whole = whole & (ids[i : len(ids) - k + 1 + i] >= 0)
    return np.flatnonzero(whole)


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Some GATHER words at a time."""
    held, size = [], 0
    for batch in batches:
        for row in batch.column("ids"):
            held.append(np.frombuffer(row.as_buffer(), np.int32).copy())
            size += len(held[-1])
            if size >= GATHER:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def _row_ids(ids: np.ndarray) -> pa.Array:
    """A stream as rows that end with a gap."""
    ids = np.append(ids, -1).astype(np.int32)
    gaps = np.flatnonzero(ids < 0) + 1
    ends = gaps[np.unique(np.searchsorted(gaps, np.arange(ROW_WORDS, len(ids) + ROW_WORDS, ROW_WORDS)).clip(max=len(gaps) - 1))]
    return pa.array([x.tobytes() for x in np.split(ids, ends[:-1])], pa.binary())


def _chunks(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The chunks of an array that aren't all 0, in the narrowest numbers that hold them."""
    task = TaskContext.get().partitionId()
    for no in range(-(-len(counts) // CHUNK)):
        part = counts[no * CHUNK : (no + 1) * CHUNK]
        if part.any():
            yield _packed(no, task, part)


def _packed(no: int, task: int, part: np.ndarray) -> pa.RecordBatch:
    kind = np.min_scalar_type(int(part.max()))
    return pa.record_batch({"chunk": pa.array([no], pa.int32()), "task": pa.array([task], pa.int32()), "width": pa.array([kind.itemsize], pa.int32()), "counts": pa.array([part.astype(kind).tobytes()], pa.binary())})


def _sum_chunks(t: pa.Table) -> pa.Table:
    total = None
    for width, counts in zip(t.column("width").to_pylist(), t.column("counts"), strict=True):
        part = np.frombuffer(counts.as_buffer(), f"u{width}")
        total = part.astype(np.uint64) if total is None else total + part
    return pa.Table.from_batches([_packed(t.column("chunk")[0].as_py(), t.column("task")[0].as_py(), total)])


_COUNTS = "chunk int, task int, width int, counts binary"


def _tree_sum(arrays: DataFrame, size: int) -> np.ndarray:
    """The sum of all tasks' arrays, FAN_IN at a time, chunk by chunk; `size` numbers come back."""
    tasks = arrays.sparkSession.sparkContext.defaultParallelism
    tasks = max(tasks, arrays.agg(F.max("task")).first()[0] or 0) + 1
    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        arrays = arrays.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int")).groupBy("chunk", "task").applyInArrow(_sum_chunks, _COUNTS)
    out = np.zeros(size, np.int64)
    for row in arrays.collect():  # `size` numbers in all: a table of counters or of candidates
        part = np.frombuffer(row.counts, f"u{row.width}")
        out[row.chunk * CHUNK : row.chunk * CHUNK + len(part)] = part
    return out


_STREAM = f"ids binary, {_COUNTS}"
_NO_IDS = pa.nulls(1, pa.binary())


class Counters:
    """A mapper's counters of phrases of k words, by some bits of their hash."""

    SEED = 1 << 20

    def __init__(self, k: int, bits: int):
        self.k, self.bits, self.counts, self.held, self.size = k, bits, np.zeros(1 << bits, np.uint32), [], 0

    @classmethod
    def places(cls, phrases: list[np.ndarray], bits: int) -> np.ndarray:
        return (phrase_hash(phrases, cls.SEED) >> np.uint64(64 - bits)).astype(np.int32)

    def add(self, ids: np.ndarray) -> None:
        at = _windows(ids, self.k)
        self.held.append(self.places([ids[at + i] for i in range(self.k)], self.bits))
        self.size += len(at)
        if self.size >= 4 * GATHER:
            self.total()

    def total(self) -> np.ndarray:
        if self.held:
            self.counts += np.bincount(np.concatenate(self.held), minlength=1 << self.bits).astype(np.uint32)
            self.held, self.size = [], 0
        return self.counts


def _stream_rows(streams: Iterator[np.ndarray], k: int, bits: int) -> Iterator[pa.RecordBatch]:
    """The streams, and at the end the counters of their phrases of k words."""
    counters, names = Counters(k, bits), ["ids", "chunk", "task", "width", "counts"]
    for ids in streams:
        if len(ids):
            counters.add(ids)
            rows = _row_ids(ids)
            none, task = pa.nulls(len(rows), pa.int32()), pa.array(np.full(len(rows), TaskContext.get().partitionId(), np.int32))
            yield pa.record_batch([rows, none, task, none, pa.nulls(len(rows), pa.binary())], names)
    for chunk in _chunks(counters.total()):
        yield pa.record_batch([_NO_IDS, *chunk.columns], names)


def _encode(vocabulary, bits: int) -> Callable:
    """Words to numbers; -1 between pieces and for words that are rare."""

    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for lang, words, piece in _gathered(batches):
            if lang not in vocabulary.value:
                continue
            first, known = vocabulary.value[lang]
            coded = words.dictionary_encode()
            number = pc.index_in(coded.dictionary, value_set=known)
            number = np.where(number.is_null().to_numpy(zero_copy_only=False), -1, number.fill_null(0).to_numpy() + first)
            ids = number[coded.indices.to_numpy()]
            gaps = np.flatnonzero(np.diff(piece)) + 1
            yield np.insert(ids, gaps, -1)

    return lambda batches: _stream_rows(streams(batches), 2, bits)


def _shorten(slots, least: int, k: int, bits: int) -> Callable:
    """Streams of length k + 1: k + 1 words follow each other where both their parts are frequent."""

    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for ids in _streams(batches):
            at = _windows(ids, k)
            found = slots.value.find([ids[at + i] for i in range(k)])
            good = np.zeros(len(ids) + 2, bool)
            good[at[found >= 0] + 1] = True
            edges = np.flatnonzero(good[1:] != good[:-1])
            begin, end = edges[::2], edges[1::2]  # good places are begin to end - 1
            begin, end = begin[end - begin > 1], end[end - begin > 1]
            lengths = end - begin + k  # their words, and a gap
            if len(begin):
                steps = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                out = ids[np.minimum(np.repeat(begin, lengths) + steps, len(ids) - 1)]
                yield np.where(steps == np.repeat(lengths - 1, lengths), -1, out)

    return lambda batches: _stream_rows(streams(batches), k + 1, bits)


def _merged(phrases: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each phrase once, with the sum of its counts."""
    if not len(phrases):
        return phrases, counts
    hashes = phrase_hash(list(phrases.T), 0)
    order = np.argsort(hashes, kind="stable")
    differ = lambda x: np.concatenate([[True], (x[1:] != x[:-1]).reshape(len(x) - 1, -1).any(axis=1)])
    new = differ(phrases[order])
    if (new != differ(hashes[order])).any():  # two phrases of one hash
        order = np.lexsort(phrases.T)
        new = differ(phrases[order])
    return phrases[order][new], np.add.reduceat(counts[order], np.flatnonzero(new))


def _candidates(heavy, named, k: int, bits: int, share: int, tasks: int) -> Callable:
    """The phrases of k words that occur `share` times in a partition, that no counter rules out, and that
    weren't named before."""

    def new(phrases: np.ndarray) -> pa.RecordBatch:
        return _columns(phrases[named.value.find(list(phrases.T)) < 0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if TaskContext.get().partitionId() >= tasks:
            raise RuntimeError("more tasks than were planned")
        phrases, counts, held, size, needed = np.zeros((0, k), np.int32), np.zeros(0, np.int64), [], 0, share
        for ids in _streams(batches):
            at = _windows(ids, k)
            words = [ids[at + i] for i in range(k)]
            kept = heavy.value[Counters.places(words, bits)]
            held.append(np.stack([w[kept] for w in words], axis=1))
            size += len(held[-1])
            if size < 4 * GATHER:
                continue
            phrases, counts = _merged(np.concatenate([phrases, *held]), np.concatenate([counts, np.ones(size, np.int64)]))
            held, size = [], 0
            if len(phrases) > 16 * GATHER:  # too many to hold: from here on all are named
                needed = 1
                yield new(phrases)
                phrases, counts = phrases[:0], counts[:0]
        phrases, counts = _merged(np.concatenate([phrases, *held]), np.concatenate([counts, np.ones(size, np.int64)]))
        yield new(phrases[counts >= needed])

    return run


def _named(scratch: Scratch, streams: DataFrame, heavy, k: int, bits: int, least: int) -> DataFrame:
    """(w0, w1, ...): the candidates of k words.

    What occurs `least` times in all does so least / tasks times in one of the tasks, and that one names
    it. Frequent phrases occur in most tasks; so that not all name them, a few tasks go first and the
    others, WAVES times as many at a time, name only what is still missing."""
    sc = streams.sparkSession.sparkContext
    writers = (streams.agg(F.max("task")).first()[0] or 0) + 1
    edges = [0, writers]
    while edges[1] > 1:
        edges.insert(1, -(-edges[1] // WAVES))
    parts = [streams.where(F.col("task").between(a, b - 1)).select("ids") for a, b in zip(edges, edges[1:], strict=False)]
    tasks = [p.rdd.getNumPartitions() for p in parts]
    share = -(-least // max(sum(tasks), 1))
    every, phrases = None, np.zeros((0, k), np.int32)
    for part, n in zip(parts, tasks, strict=True):
        named = sc.broadcast(Slots(phrases))
        one = scratch.cut(part.mapInArrow(_candidates(heavy, named, k, bits, share, n), _phrase_schema(k)).distinct())
        every = one if every is None else every.unionByName(one)
        phrases = np.concatenate([phrases, _collected(one)])
        named.unpersist()
    return every


def _collected(phrases: DataFrame) -> np.ndarray:
    """A table of candidates: fewer than its words / 100, and what counters let pass."""
    return np.stack([c.to_numpy() for c in phrases.toArrow().columns], axis=1).astype(np.int32)


def _columns(phrases: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({f"w{i}": pa.array(phrases[:, i], pa.int32()) for i in range(phrases.shape[1])})


def _phrase_schema(k: int) -> str:
    return ", ".join(f"w{i} int" for i in range(k))


def _count(slots, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(slots.value.stored), np.int64)
        for ids in _streams(batches):
            at = _windows(ids, k)
            found = slots.value.find([ids[at + i] for i in range(k)])
            counts += np.bincount(found[found >= 0], minlength=len(counts))
        yield from _chunks(counts)

    return run


def _scored(tables, vocabulary, sizes: dict[str, int], factor: int, k: int) -> Callable:
    """Of candidates of k words: their counts and lowest cut, by slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = sorted(vocabulary.value, key=lambda x: vocabulary.value[x][0])
        firsts = np.array([vocabulary.value[x][0] for x in langs])
        for batch in batches:
            phrases = [batch.column(i).to_numpy() for i in range(k)]
            slot = tables.value[k].find(phrases)
            phrases, slot = [w[slot >= 0] for w in phrases], slot[slot >= 0]
            if not len(slot):
                continue
            a = tables.value[k].counts[slot].astype(object)  # whole numbers of any size
            of = np.searchsorted(firsts, phrases[0], side="right") - 1
            n = np.array([sizes[x] for x in langs], object)[of]
            best = None
            for cut in range(1, k):
                l, r = (t.counts[t.find(part)].astype(object) for t, part in ((tables.value[cut], phrases[:cut]), (tables.value[k - cut], phrases[cut:])))
                score = factor * a * n // (l * r)
                if best is None:
                    best = [score, l, r]
                else:
                    lower = score < best[0]
                    best = [np.where(lower, new, old) for new, old in zip((score, l, r), best, strict=True)]
            texts = [[vocabulary.value[langs[o]][1][int(w - firsts[o])].as_py() for w in ws] for o, *ws in zip(of, *phrases, strict=True)]
            numbers = {c: pa.array([int(x) for x in v], pa.int64()) for c, v in (("a", a), ("l", best[1]), ("r", best[2]), ("n", n), ("score", best[0]))}
            names = {"lang": pa.array([langs[o] for o in of], pa.string()), "phrase": pa.array([" ".join(t) for t in texts], pa.string())}
            yield pa.record_batch(names | numbers | {"k": pa.array(np.full(len(slot), k), pa.int32()), "slot": pa.array(slot, pa.int64())})

    return run


def _contained(tables, k: int) -> Callable:
    """Slots of the parts, one word shorter, of candidates of k words that occur as often. A shorter part
    that occurs as often as a longer phrase does so as often as what lies between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases = [batch.column(i).to_numpy() for i in range(k)]
            slot = tables.value[k].find(phrases)
            phrases, a = [w[slot >= 0] for w in phrases], tables.value[k].counts[slot[slot >= 0]]
            for part in (phrases[:-1], phrases[1:]):
                at = tables.value[k - 1].find(part)
                at = np.unique(at[tables.value[k - 1].counts[at] == a])
                yield pa.record_batch({"in_k": pa.array(np.full(len(at), k - 1), pa.int32()), "in_slot": pa.array(at, pa.int64())})

    return run


def collocations(docs: DataFrame, *, least: int = LEAST, longest: int = LONGEST, top: int = TOP, factor: int = FACTOR, words_a_counter: int = WORDS_A_COUNTER) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases of 2 to `longest` words.

    a counts the phrase, n all words of the language; the score is the lowest over all cuts of
    floor(factor * a * n / (l * r)) for the counts l and r of the parts. Phrases that lie in a longer
    one that occurs as often are left out."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch, sc = Scratch(spark), spark.sparkContext
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words = rows.mapInArrow(_count_words, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))
    words = scratch.cut(words)
    sizes = {r.lang: r.n for r in words.groupBy("lang").agg(F.sum("f").alias("n")).collect()}
    frequent = words.where(F.col("f") >= least).orderBy("lang", "word").toArrow().combine_chunks()
    vocabulary, counts = {}, frequent.column("f").to_numpy()
    langs = frequent.column("lang").to_pylist()
    for lang in sorted(set(langs), key=lambda x: x.encode()):
        first = langs.index(lang)
        vocabulary[lang] = (first, pa.concat_arrays(frequent.column("word").slice(first, langs.count(lang)).chunks))
    ones = Slots(np.arange(len(counts), dtype=np.int32)[:, None])
    ones.counts[ones.find([np.arange(len(counts), dtype=np.int32)])] = counts
    known, tables = sc.broadcast(vocabulary), {1: ones}
    bits = int(np.clip(np.floor(np.log2(max(sum(sizes.values()) // words_a_counter, 1))), LEAST_BITS, MOST_BITS))
    made = scratch.cut(rows.mapInArrow(_encode(known, bits), _STREAM))
    found = {}
    for k in range(2, longest + 1):
        heavy = sc.broadcast(_tree_sum(made.where("ids IS NULL").drop("ids"), 1 << bits) >= least)
        streams = made.where("ids IS NOT NULL").select("ids")
        found[k] = _named(scratch, made.where("ids IS NOT NULL").select("task", "ids"), heavy, k, bits, least)
        slots = Slots(_collected(found[k]))
        sent = sc.broadcast(slots)
        counts = _tree_sum(streams.mapInArrow(_count(sent, k), _COUNTS), len(slots.stored))
        tables[k] = Slots(slots.stored[counts >= least])
        tables[k].counts[tables[k].find(list(slots.stored[counts >= least].T))] = counts[counts >= least]
        heavy.unpersist()
        sent.unpersist()
        if k < longest:
            sent = sc.broadcast(tables[k])
            last, made = made, scratch.cut(streams.mapInArrow(_shorten(sent, least, k, bits), _STREAM))
            scratch.drop(last)
            sent.unpersist()
    every = sc.broadcast(tables)
    scored = inner = None
    for k, phrases in found.items():
        one = phrases.mapInArrow(_scored(every, known, sizes, factor, k), "lang string, phrase string, a long, l long, r long, n long, score long, k int, slot long")
        scored = one if scored is None else scored.unionByName(one)
        if k > 2:
            held = phrases.mapInArrow(_contained(every, k), "in_k int, in_slot long")
            inner = held if inner is None else inner.unionByName(held)
    if inner is not None:
        scored = scored.join(inner.distinct(), (F.col("k") == F.col("in_k")) & (F.col("slot") == F.col("in_slot")), "left_anti")
    best = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: collocations() in DuckDB's SQL, with every phrase counted.
SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents WHERE text IS NOT NULL),
worded AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
placed AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM worded, range(1, {LONGEST + 1}) r(k)),
counted AS (SELECT lang, k, w[i : i + k - 1] AS g, count(*) AS a FROM placed GROUP BY ALL HAVING count(*) >= {LEAST}),
cuts AS (
  SELECT c.lang, c.k, c.g, c.a, n, cut, l.a AS l, r.a AS r, ({FACTOR}::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a) AS score
  FROM counted c JOIN sizes USING (lang) JOIN range(1, {LONGEST}) x(cut) ON cut < c.k
  JOIN counted l ON l.lang = c.lang AND l.g = c.g[1 : cut] JOIN counted r ON r.lang = c.lang AND r.g = c.g[cut + 1 : c.k]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
parts AS (
  SELECT DISTINCT lang, a, g[i : i + m - 1] AS part FROM counted, range(2, {LONGEST}) x(m), range(1, {LONGEST + 1}) y(i) WHERE m < k AND i + m - 1 <= k),
kept AS (SELECT *, array_to_string(g, ' ') AS phrase FROM lowest c WHERE NOT EXISTS (SELECT 1 FROM parts p WHERE p.lang = c.lang AND p.part = c.g AND 100 * p.a >= 100 * c.a))
SELECT lang, row_number() OVER o AS rank, phrase, a, l, r, n, score::BIGINT AS score FROM kept
WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) QUALIFY row_number() OVER o <= {TOP}
"""
