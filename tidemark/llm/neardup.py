"""Near-duplicates by DartMinHash signatures, banded joins and exact verification.

A document is the set of its shingles of five words (all its words, where it has fewer). Darts
are thrown, by hashing, at every shingle's region of weight times rank: their ranks form a Poisson
process of unit rate per unit of weight, so two documents that share a shingle share its darts. A
document takes its darts up to a rank at which every coordinate is hit, a few hundred whatever its
length, and keeps the earliest dart of each coordinate. A coordinate of two documents agrees with
the chance of their weighted Jaccard similarity (after Christiani's DartMinHash).

Equal texts are merged first, by their digest. Signatures are cut into bands; rows that agree in a
band are joined to the group's leader, the row that agrees with most others over all bands, never
pairwise. Those that also agree in the next band have a leader of their own, so a mixed group
doesn't hide its parts. Each such pair is verified over the whole texts, and links are joined into
classes by contraction to the least id. Where a band's rows are of two classes still, the classes
may be linked by other rows than the leader: an exact join on rare shingles finds every link of
such rows to rows of other classes.

Defined results: texts without words (null, empty, blank) are alone, each in its own class;
repeated rows and equal texts share a class; a class is named by its least doc_id; rows with a
null doc_id and equal texts to none have class null; a very long text is read whole; an empty table
gives no rows; extra columns are ignored, and keep_firsts hands them on, whatever they are called.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, cut, free_names, ordering, small_batches, use_worker

WORDS, SIMILARITY = 5, 0.8
#: Bands x rows coordinates. A pair of similarity s shares a band with chance 1 - (1 - s^4)^16: 0.9998 at 0.8, 0.99999 at 0.85.
BANDS, ROWS = 16, 4
#: Counters that put shingles in an order from rare to common.
SKETCH = 1 << 18
#: Ids with many neighbours whose least neighbour is broadcast, at most.
LOUD_IDS = 100_000
#: So many ids may be broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
_M1, _M2, _M3 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BYTES = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that looks random."""
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


_POWERS = np.cumprod(np.concatenate((np.ones(1, dtype=np.uint64), np.full(255, _M3))), dtype=np.uint64)


def word_hashes(text: str | bytes) -> np.ndarray:
    """A 64-bit hash of each word (a run of anything but ASCII white space), in order."""
    raw = np.frombuffer(text.encode() if isinstance(text, str) else text, dtype=np.uint8)
    blank = _BLANK[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True]))))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    letters = _BYTES[raw]
    at = np.arange(len(raw)) - np.repeat(start, np.diff(np.append(start, len(raw)))) if start[0] == 0 else np.arange(len(raw)) - np.concatenate((np.zeros(start[0], dtype=np.int64), np.repeat(start, np.diff(np.append(start, len(raw))))))
    if (end - start).max() > 256:  # a long word: its power is taken modulo, with the block mixed in
        letters = letters ^ mix64((at >> 8).astype(np.uint64))
        letters[at < 256] = _BYTES[raw[at < 256]]
    letters = letters * _POWERS[at & 255]
    letters[blank] = 0
    return mix64(np.add.reduceat(letters, start) + (end - start).astype(np.uint64))


def shingles(text: str | bytes, words: int = WORDS) -> np.ndarray:
    """The hashes of a text's shingles, one for each place; one in all where it has fewer words."""
    h = word_hashes(text)
    n = max(1, len(h) - words + 1) if len(h) else 0
    if not n:
        return h
    width = min(words, len(h))
    out = np.full(n, np.uint64(width))
    for i in range(width):
        out = out * _M3 + h[i : i + n]
    return mix64(out)


def weighted(places: np.ndarray, weighting: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and their weights: 1 each ("set") or how often they occur ("count")."""
    x, n = np.unique(places, return_counts=True)
    return x, (np.ones(len(x)) if weighting == "set" else n.astype(float))


def dart_minhash(sets: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """Of each weighted set (elements, weights), the k earliest darts' ids. Two sets' coordinates
    agree with the chance of their weighted Jaccard similarity, sum of minima over sum of maxima."""
    out = np.zeros((len(sets), k), dtype=np.uint64)
    todo, reach = np.arange(len(sets)), np.log(k) + 3.0
    while len(todo):
        x = np.concatenate([sets[i][0] for i in todo])
        w = np.concatenate([sets[i][1] for i in todo])
        owner = np.repeat(np.arange(len(todo)), [len(sets[i][0]) for i in todo])
        rank_to = reach * k / np.bincount(owner, w, len(todo))
        strips = np.ceil(w).astype(np.int64)  # unit strips of weight; the last may be a part of one
        if strips.max() > 1:
            which = np.repeat(np.arange(len(x)), strips)
            strip = np.arange(len(which)) - np.repeat(np.cumsum(strips) - strips, strips)
            x, owner = x[which], owner[which]
            limit = np.minimum(w[which] - strip, 1.0)
            live = mix64(x + mix64(strip.astype(np.uint64) * _M3 + np.uint64(1)))
        else:
            limit, live = w, mix64(x + mix64(np.ones(1, dtype=np.uint64)))
        whole = bool((limit == 1.0).all())
        ranks, ids, rank, to, step = [], [], np.zeros(len(live)), rank_to[owner], np.zeros(1, dtype=np.uint64)
        while len(live):  # the next dart of each strip that goes on
            step = step + _M3
            dart = mix64(live + step)
            rank = rank - np.log(((dart >> np.uint64(11)).astype(float) + 1.0) * 2.0**-53)
            on = np.flatnonzero(rank <= to)
            live, rank, to, owner, dart = live[on], rank[on], to[on], owner[on], dart[on]
            if not whole:  # darts beside the last strip's weight miss
                limit = limit[on]
                at = np.flatnonzero((mix64(dart + np.uint64(7)) >> np.uint64(11)).astype(float) * 2.0**-53 < limit)
                dart, hits = dart[at], (rank[at], owner[at])
            else:
                hits = rank, owner
            dart = mix64(dart + np.uint64(13))
            ranks.append(hits[0])
            ids.append((dart, hits[1] * k + (dart % np.uint64(k)).astype(np.int64)))
        order = np.argsort(np.concatenate(ranks))[::-1]
        dart, place = (np.concatenate(a)[order] for a in zip(*ids))
        got, hit = np.zeros(len(todo) * k, dtype=np.uint64), np.zeros(len(todo) * k, dtype=bool)
        got[place] = dart  # the last assignment, the least rank, stays
        hit[place] = True
        full = hit.reshape(-1, k).all(axis=1)
        out[todo[full]] = got.reshape(-1, k)[full]
        todo, reach = todo[~full], reach * 2
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key of each band of each signature."""
    s = signature.reshape(len(signature), bands, rows)
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64), s.shape[:2])
    for i in range(rows):
        out = mix64(out * _M3 + s[:, :, i])
    return out.view(np.int64)


def similarity(a: str | bytes, b: str | bytes, words: int = WORDS, weighting: str = "set") -> float:
    """Weighted Jaccard similarity of two texts' shingles, over the whole texts."""
    (x, v), (y, w) = (weighted(shingles(t, words), weighting) for t in (a, b))
    if not len(x) or not len(y):
        return 0.0
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    least = np.minimum(v[i], w[j]).sum()
    return float(least / (v.sum() + w.sum() - least))


def _text_id():
    """Equal for equal texts: 64 bits of a digest."""
    return F.xxhash64(F.unhex(F.md5(F.col("text").cast("binary"))))


def signatures(docs: DataFrame, *, words: int = WORDS, bands: int = BANDS, rows: int = ROWS, weighting: str = "set") -> DataFrame:
    """(doc_id, id, keys array<long>, sig array<int>) of docs(doc_id, text): a text's id, its bands
    and 32 bits of each coordinate; keys and sig null for texts without words."""

    def run(batches):
        use_worker("neardup")
        for b in batches:
            keys, sigs, sets, at, held = [None] * len(b), [None] * len(b), [], [], 0
            for i, t in enumerate(b.column(2)):
                x = weighted(shingles(t.as_buffer().to_pybytes() if t.is_valid else b"", words), weighting)
                if len(x[0]):
                    sets.append(x)
                    at.append(i)
                    held += len(x[0])
                if held > 200_000 or (held and i == len(b) - 1):  # as many at once as memory is sure to hold
                    s = dart_minhash(sets, bands * rows)
                    for n, own, sig in zip(at, band_keys(s, bands, rows), s.astype(np.uint32).view(np.int32)):
                        keys[n], sigs[n] = own, sig
                    sets, at, held = [], [], 0
            out = [b.column(0), b.column(1), pa.array(keys, pa.list_(pa.int64())), pa.array(sigs, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "id", "keys", "sig"])

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_id().alias("id"), F.col("text").cast("binary").alias("text"))
    return text.mapInArrow(run, "doc_id long, id long, keys array<long>, sig array<int>")


def _texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """ids(id, of, ...) with their texts, from docs(of, text); a repeated row counts once. Texts
    are hashed only where a row has a wanted doc_id."""
    wanted = ids.withColumnRenamed("id", "wanted")
    if ids.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    met = docs.join(wanted, "of").where(_text_id() == F.col("wanted"))
    firsts = [F.first(c).alias(c) for c in ids.columns if c not in ("id", "of")]
    return met.groupBy(F.col("wanted").alias("id")).agg(*firsts, F.first("text").alias("text"))


def verified(pairs: DataFrame, texts: DataFrame, *, words: int, least: float, weighting: str) -> DataFrame:
    """Those of pairs(a, b) that are similar; their texts(id, text) are compared whole."""

    def run(batches):
        use_worker("neardup")
        for batch in batches:
            last, cached = None, None
            similar = []
            for a, s, t in zip(batch.column(0), batch.column(2), batch.column(3)):
                if a != last:  # rows come sorted by leader, mostly
                    last, cached = a, weighted(shingles(s.as_buffer().to_pybytes(), words), weighting)
                (x, v), (y, w) = cached, weighted(shingles(t.as_buffer().to_pybytes(), words), weighting)
                _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
                common = np.minimum(v[i], w[j]).sum()
                similar.append(bool(common >= least * (v.sum() + w.sum() - common)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(similar, pa.bool_()))

    first = texts.join(pairs.select(F.col("a").alias("id")).distinct(), "id", "left_semi")
    left = first.select(F.col("id").alias("a"), F.col("text").alias("s"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("t"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "s", "t").mapInArrow(run, "a long, b long")


def _led(members: DataFrame, *group: str) -> DataFrame:
    """members(key, next, id, central), those in groups of two or more, with `leader`, the most
    central row of the group."""
    leaders = members.groupBy(*group).agg(F.max(F.struct("central", "id")).alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = members.join(leaders.select(*group, F.col("lead.id").alias("leader")), list(group))
    return met.select("key", "next", "id", "central", "leader")


def _pairs(led: DataFrame) -> DataFrame:
    """Distinct (a, b): leader and row, either of two rows that lead each other once."""
    both = led.where("id <> leader").groupBy(F.least("id", "leader").alias("x"), F.greatest("id", "leader").alias("y")).agg(F.max("leader").alias("a"))
    return both.select("a", (F.when(F.col("a") == F.col("x"), F.col("y")).otherwise(F.col("x"))).alias("b"))


def _likely(pairs: DataFrame, named: DataFrame, least: float) -> DataFrame:
    """pairs whose signatures agree in so many coordinates that their similarity may be `least`.
    The others' texts aren't read here; as rows that aren't in one class, they stay in a mixed
    group, whose links are all found by `candidates`."""
    k = F.size("s")
    agree = F.size(F.filter(F.zip_with("s", "t", lambda x, y: x == y), lambda x: x))
    sig = lambda id_, name: named.select(F.col("id").alias(id_), F.col("sig").alias(name))
    met = pairs.join(sig("b", "t"), "b").join(sig("a", "s"), "a")
    return met.where(agree >= k * least - 5 * F.sqrt(k * least * (1 - least))).select("a", "b")


def size_class(n: int) -> int:
    """Eight classes from a size to its double."""
    return int(np.floor(8 * np.log2(n)))


@lru_cache(4096)
def _first_size(c: int) -> int:
    n = max(1, int(2 ** (c / 8)) - 1)
    while size_class(n) < c:
        n += 1
    return n


def prefix(x: np.ndarray, times: np.ndarray, least: float) -> list[tuple[int, np.ndarray]]:
    """Of a set, for each size class that a similar set can have: (class, the elements that count).
    Elements stand in one order of all sets, the rare ones first, by times[hash]. Of two sets at
    least `least` similar, x lacks (|x| - least * |y|) / (1 + least) elements of y at most, so the
    first common element comes after no more of them than that."""
    n = len(x)
    order = x[np.lexsort((x, times[(x & np.uint64(len(times) - 1)).astype(np.int64)]))]
    low, high = int(np.ceil(n * least - 1e-9)), int(n / least + 1e-9)
    out = []
    for c in range(size_class(max(low, 1)), size_class(high) + 1):
        lacks = (n - least * max(low, _first_size(c))) / (1 + least)
        if lacks > -1e-9:
            out.append((c, order[: int(lacks + 1e-9) + 1]))
    return out


def candidates(rest: DataFrame, *, words: int, least: float, weighting: str) -> DataFrame:
    """(a, b): every pair of rest(id, root, stray, text) of two roots, a stray, that can be similar
    by the rule of `prefix`: an exact join on rare shingles. A count of shingles by SKETCH hashes,
    over all of rest, puts them in order; any order is right, this one keeps common ones out."""

    def elements(t: pa.Scalar) -> np.ndarray:
        x, w = weighted(shingles(t.as_buffer().to_pybytes(), words), weighting)
        again = [mix64(x[w > i] + np.uint64(i) * _M3) for i in range(1, int(w.max(initial=1)))]
        return np.concatenate((x, *again)) if again else x

    def count(batches):
        use_worker("neardup")
        n = np.zeros(SKETCH, dtype=np.int64)
        for b in batches:
            for t in b.column(0):
                np.add.at(n, (elements(t) & np.uint64(SKETCH - 1)).astype(np.int64), 1)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["at", "n"])

    counted = rest.select("text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # SKETCH rows
    times = np.zeros(SKETCH, dtype=np.int64)
    times[counted["at"].to_numpy()] = counted["n"].to_numpy()
    shared = rest.sparkSession.sparkContext.broadcast(times)  # 8 bytes each

    def emit(batches):
        use_worker("neardup")
        for b in batches:
            out = []
            for i, (stray, t) in enumerate(zip(b.column(2).to_pylist(), b.column(3))):
                x = elements(t)
                own = size_class(len(x))
                for c, first in prefix(x, shared.value, least):
                    for side in (0, 1)[: 1 + stray]:  # 1: as the stray row of a pair
                        met = (own << 12 | c) if side else (c << 12 | own)
                        out.append((i, side, len(x), mix64(first + mix64(np.array([met], dtype=np.uint64)))))
                if out and (len(out) > 20_000 or i == len(b) - 1):
                    at = np.repeat([o[0] for o in out], [len(o[3]) for o in out])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate([o[3] for o in out]).view(np.int64)),
                            b.column(0).take(pa.array(at)),
                            b.column(1).take(pa.array(at)),
                            pa.array(np.repeat([o[1] for o in out], [len(o[3]) for o in out]).astype(np.int32)),
                            pa.array(np.repeat([o[2] for o in out], [len(o[3]) for o in out]).astype(np.int32)),
                            pa.array(np.concatenate([np.arange(len(o[3])) for o in out]).astype(np.int32)),
                        ],
                        names=["key", "id", "root", "side", "n", "place"],
                    )
                    out = []

    rows = rest.select("id", "root", "stray", "text").mapInArrow(emit, "key long, id long, root long, side int, n int, place int")
    name = lambda side, p: rows.where(F.col("side") == side).select("key", *[F.col(c).alias(p + c) for c in ("id", "root", "n", "place")])
    lacks = lambda x, y: (F.col(x) - least * F.col(y)) / (1 + least) + 1e-9
    met = name(1, "a_").join(name(0, "b_"), "key").where("a_root <> b_root")
    met = met.where((F.col("a_place") <= lacks("a_n", "b_n")) & (F.col("b_place") <= lacks("b_n", "a_n")))
    return met.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")).distinct()


def roots(named: DataFrame, docs: DataFrame, scratch: Scratch, *, words: int = WORDS, least: float = SIMILARITY, weighting: str = "set") -> DataFrame:
    """(id, root) of each of named(id, of, keys, sig): texts of one root are joined by links."""
    compare = {"words": words, "least": least, "weighting": weighting}
    band = named.select("id", "keys", F.posexplode("keys").alias("band", "key"))
    nexts = F.element_at("keys", ((F.col("band") + 1) % F.size("keys") + 1).cast("int")).alias("next")
    sizes = band.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = scratch.cut(band.select("key", nexts, "id").join(sizes, "key"))
    # The row that others are copies of shares a band with most of them in every band.
    central = members.groupBy("id").agg(F.sum("n").alias("central"))
    wide = scratch.cut(_led(members.drop("n").join(central, "id"), "key"))
    pairs = scratch.cut(_pairs(wide.unionByName(_led(wide.drop("leader"), "key", "next"))))
    likely = scratch.cut(_likely(pairs, named, least))
    both = named.select("id", "of").join(likely.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_semi")
    both = scratch.cut(both)
    linked = scratch.cut(verified(likely, _texts_of(both, docs), **compare))
    known = components(linked, scratch)
    scratch.drop(members, pairs, likely, both, linked)
    # Where a group has rows of two roots, other rows than its leader may link them.
    rooted = wide.join(known, "id", "left").select("key", "id", "leader", F.coalesce("root", "id").alias("root"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max(F.when(F.col("id") == F.col("leader"), F.col("root"))).alias("lead"))
    mixed = mixed.where("low <> high").select("key", "lead")
    rest = rooted.join(mixed, "key").groupBy("id").agg(F.max("root").alias("root"), F.max((F.col("root") != F.col("lead")).cast("int")).alias("stray"))
    rest = scratch.cut(named.select("id", "of").join(rest, "id"))
    texts = scratch.cut(_texts_of(rest, docs))
    pairs = scratch.cut(candidates(texts, **compare))
    more = verified(pairs, texts.select("id", "text"), **compare)
    of = texts.select("id", "root")
    joined = more.join(of.select(F.col("id").alias("a"), F.col("root").alias("x")), "a").join(of.select(F.col("id").alias("b"), F.col("root").alias("y")), "b")
    top = components(joined.select(F.col("x").alias("a"), F.col("y").alias("b")), scratch)
    top = scratch.renamed(top, id="r", root="top")
    out = named.select("id").join(known, "id", "left").select("id", F.coalesce("root", "id").alias("r")).join(top, "r", "left")
    out = scratch.cut(out.select("id", F.coalesce("top", "r").alias("root")))
    scratch.drop(wide, known, rest, texts, pairs, top)
    return out


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, root): the least id that links reach, of each id in edges(a, b). Each round links every
    id with the least of its neighbours (larger ones, then smaller ones), until nothing moves. An
    id with very many neighbours doesn't gather them in one task: what it is told is broadcast."""

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()

    def told(rows: DataFrame, what: DataFrame, key: str, value: str) -> DataFrame:
        """rows with `value` of what(key, value, n), n its rows: 2 * LOUD_IDS ids at most have so many."""
        many = F.col("n") >= loud
        hot = F.broadcast(what.where(many).select(key, F.col(value).alias("hot")))
        met = rows.join(hot, key, "left")
        rest = met.where("hot IS NULL").drop("hot").join(what.where(~many).select(key, value), key)
        return rest.unionByName(met.where("hot IS NOT NULL").withColumnRenamed("hot", value))

    e = scratch.cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    now = mark(e)
    while True:
        loud = max(500, now[0] // LOUD_IDS)
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = scratch.cut(told(both.where("v > u"), low, "u", "m").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct())
        low = large.groupBy("b").agg(F.min("a").alias("p"), F.count(F.lit(1)).alias("n"))
        small = told(large, low, "b", "p")
        last, before = e, now
        e = scratch.cut(small.select(F.col("p").alias("a"), "b").unionByName(small.where("a <> p").select(F.col("p").alias("a"), F.col("a").alias("b"))).distinct())
        now = mark(e)
        scratch.drop(last, large)
        if now == before:
            return scratch.renamed(e, b="id", a="root")


def classes(docs: DataFrame, *, words: int = WORDS, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, weighting: str = "set") -> DataFrame:
    """(doc_id, class_id, text_key, class_key) for each row of docs(doc_id, text). A text goes by
    64 bits of its digest, text_key; class_key is that of the class's first document, class_id."""
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession)
    all_rows = scratch.cut(signatures(docs, words=words, bands=bands, rows=rows, weighting=weighting))
    own = all_rows.where("keys IS NOT NULL")
    no_id = F.lit(-(2**63))
    by_text = own.groupBy("id").agg(F.min("doc_id").alias("least"), F.min("keys").alias("keys"), F.min("sig").alias("sig"))
    named = scratch.cut(by_text.withColumn("of", F.coalesce("least", no_id)))
    texts = docs.where("text IS NOT NULL").select(F.coalesce(F.col("doc_id").cast("long"), no_id).alias("of"), F.col("text").cast("binary").alias("text"))
    found = roots(named, texts, scratch, words=words, least=least, weighting=weighting)
    met = named.select("id", "least").join(found, "id")
    names = met.groupBy("root").agg(F.min(F.struct(F.col("least").isNull(), "least", "id")).alias("first"))
    of_text = scratch.cut(met.join(names, "root").select("id", F.col("first.least").alias("class_id"), F.col("first.id").alias("class_key")))
    narrow = scratch.cut(all_rows.select("doc_id", "id", F.col("keys").isNotNull().alias("worded")))
    scratch.drop(all_rows, named, found)
    known = narrow.where("worded").select("doc_id", "id").join(of_text, "id").select("doc_id", "class_id", F.col("id").alias("text_key"), "class_key")
    none = F.lit(None).cast("long")
    alone = narrow.where("NOT worded").select("doc_id", F.col("doc_id").alias("class_id"), none.alias("text_key"), none.alias("class_key"))
    return known.unionByName(alone)


def keep_firsts(docs: DataFrame, **how) -> DataFrame:
    """docs with one row of each class, its first document; all rows without words stay. Of rows with
    that document's id and text, the one whose other columns come first stays."""
    cols = docs.columns
    k_id, k_key = free_names(cols, "k_id", "k_key")
    found = classes(docs, **how).where("text_key = class_key AND doc_id <=> class_id")
    found = cut(found.groupBy(F.coalesce("doc_id", F.lit(-(2**63))).alias(k_id), F.col("text_key").alias(k_key)).count())
    firsts, n = found.select(k_id, k_key), found.count()
    rows = docs.select("*", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias(k_id), _text_id().alias(k_key))
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # Repeated rows (the same id and text) are rare; only these are numbered.
    again = found.where("count > 1").select(k_id, k_key)
    met = rows.where(worded).join(F.broadcast(firsts) if n <= BROADCAST_IDS else firsts, [k_id, k_key], "left_semi")
    if not again.isEmpty():
        (k_no,) = free_names(met.columns, "k_no")
        same = W.partitionBy(k_id, k_key).orderBy(*ordering(docs, "doc_id", "text"))
        repeated = met.join(again, [k_id, k_key], "left_semi").withColumn(k_no, F.row_number().over(same)).where(F.col(k_no) == 1).drop(k_no)
        met = met.join(again, [k_id, k_key], "left_anti").unionByName(repeated)
    return met.select(*cols).unionByName(rows.where(~worded).select(*cols))
