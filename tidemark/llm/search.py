"""Exact top-k search: BM25 over an inverted index in shards, with block-max WAND pruning.

Terms are runs of ASCII letters, digits and non-ASCII bytes, ASCII letters in lower case. Each
partition becomes shards of some thousand documents; a shard holds its postings by term, then
document, and is written once. Its documents stand by kind (clusters by their terms), then
length, so that documents of a block are alike. Document counts, lengths and document frequencies
are gathered over all shards, so every shard scores with the same global statistics and merging
the shards' best k is exact.

A query reads a shard's lists from the rarest term on, some at a time and for all documents at
once. A document is a pivot while its score in the lists read so far and its block's maxima in
those unread may reach the k-th best score; blocks without a pivot are skipped from then on. That
threshold starts at what earlier shards gave (some are asked before all others), or the whole scores of the best documents by the
rarest terms, and rises with the scores.

Queries go in blocks of bounded size, each against all shards. Nothing is capped: every document
is indexed, every query is run whole.

Defined results: a null or empty text is a document of length 0 and no query; a document without
a query's terms has no score and isn't listed; ties go to the smaller doc_id, null last; repeated
rows are documents of their own; a very long text is indexed and asked whole; an empty table gives
no rows; extra columns are ignored; queries are known by their id, and repeated ids run once, with
the least text.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, batches_of, small_batches, use_worker
from .neardup import mix64

K1, B, TOP = 1.2, 0.75, 10
#: Documents and bytes of text of a shard, at most one text more; documents of a block.
SHARD_DOCS, SHARD_BYTES, BLOCK = 8_192, 32_000_000, 16
#: Kinds of documents in a shard, and the classes of terms that tell them apart.
KINDS, KIND_TERMS = 12, 256
#: Lists are read by LISTS, then by as many more as a GROWTH-th of those read.
LISTS, GROWTH = 16, 2
#: Lists of a shard's documents / SHORT postings are read whole. A threshold starts from the best of
#: SEEDS * k documents by these lists and HOPE of what their blocks may add.
SHORT, SEEDS, HOPE = 8, 2, 0.2
#: Each block of queries meets one in FIRST of the tasks' shards first; the others begin with its thresholds.
FIRST = 6
#: Queries, and terms of all of them, of a query block: what is sent to every shard at once.
QUERY_BLOCK, QUERY_TERMS = 4_096, 1_000_000
_FOLD = np.zeros(256, dtype=np.uint8)  # 0: between terms
_FOLD[list(b"abcdefghijklmnopqrstuvwxyz0123456789") + list(range(128, 256))] = list(b"abcdefghijklmnopqrstuvwxyz0123456789") + list(range(128, 256))
_FOLD[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = list(b"abcdefghijklmnopqrstuvwxyz")
_LETTER = np.random.default_rng(9).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = np.cumprod(np.full(256, np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64)


def terms_of(text: bytes) -> np.ndarray:
    """A 64-bit hash of each term, in order."""
    raw = _FOLD[np.frombuffer(text, dtype=np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], (raw != 0).view(np.int8), [0]))))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    at = np.arange(len(raw), dtype=np.int64)
    at[start[0] :] -= np.repeat(start, np.diff(np.append(start, len(raw))))
    letters = _LETTER[raw]
    if (end - start).max() > 256:  # places repeat; the block of a place is mixed in
        letters = np.where(at < 256, letters, mix64(letters ^ (at >> 8).astype(np.uint64)))
    letters = letters * _PLACE[at & 255]
    letters[raw == 0] = 0
    return mix64(np.add.reduceat(letters, start) + (end - start).astype(np.uint64))


_INDEX = "n_docs long, ids array<long>, lengths array<int>, terms array<long>, offsets array<int>, docs array<short>, tfs array<int>"


def _kinds(terms: np.ndarray, tf: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """A cluster of each document, by how often its terms fall into KIND_TERMS classes of hashes: some
    rounds of means, from documents far apart."""
    at = (terms & np.uint64(KIND_TERMS - 1)).astype(np.int32)
    at += doc * np.int32(KIND_TERMS)
    x = np.log1p(np.bincount(at, tf, n * KIND_TERMS).reshape(n, KIND_TERMS)).astype(np.float32)
    x /= np.maximum(np.sqrt((x**2).sum(axis=1, keepdims=True)), 1e-9)
    means, near = [x.mean(axis=0)], x @ x.mean(axis=0)
    for _ in range(KINDS):
        means.append(x[near.argmin()])
        near = np.maximum(near, x @ means[-1])
    means = np.array(means)
    for _ in range(4):
        kind = (x @ means.T).argmax(axis=1)
        for k in np.unique(kind):
            means[k] = x[kind == k].mean(axis=0)
            means[k] /= max(np.sqrt((means[k] ** 2).sum()), 1e-9)
    return (x @ means.T).argmax(axis=1)


def _counted(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms of a text, and how often it has each."""
    terms, n = np.unique(terms, return_counts=True)
    return terms, n.astype(np.int32)


def _shard(ids: list, texts: list[np.ndarray]) -> pa.RecordBatch:
    return _packed(ids, [_counted(t) for t in texts])


def _packed(ids: list, texts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """A shard of texts as _counted() gives them, which are taken out of their list. An executor's
    workers are here at once, so what isn't needed any more goes before the next step."""
    n, lengths = len(texts), np.array([tf.sum() for _, tf in texts], dtype=np.int32)
    doc = np.repeat(np.arange(n, dtype=np.int32), [len(t) for t, _ in texts])
    every, tf = np.concatenate([t for t, _ in texts]), np.concatenate([x for _, x in texts])
    texts.clear()
    rows = np.lexsort((lengths, _kinds(every, tf, doc, n)))
    lengths, ids = lengths[rows], [ids[i] for i in rows]
    doc = np.argsort(rows).astype(np.int32)[doc]
    terms, at = np.unique(every, return_inverse=True)
    del every
    at *= n  # now term and document in one
    at += doc
    del doc
    order = np.argsort(at)
    at, tf = at[order], tf[order]
    del order
    doc = (at % n).astype(np.int16)
    at //= n
    offsets = np.searchsorted(at, np.arange(len(terms) + 1)).astype(np.int32)
    del at
    row = [
        pa.array([n], pa.int64()),
        pa.array([ids], pa.list_(pa.int64())),
        pa.array([lengths], pa.list_(pa.int32())),
        pa.array([terms.view(np.int64)], pa.list_(pa.int64())),
        pa.array([offsets], pa.list_(pa.int32())),
        pa.array([doc], pa.list_(pa.int16())),
        pa.array([tf], pa.list_(pa.int32())),
    ]
    return pa.RecordBatch.from_arrays(row, names=["n_docs", "ids", "lengths", "terms", "offsets", "docs", "tfs"])


def build_index(docs: DataFrame, shard_docs: int = SHARD_DOCS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """A row for each shard of docs(doc_id, text)."""
    assert shard_docs <= 32_767
    small_batches(docs.sparkSession)

    def run(batches):
        use_worker("search")
        ids, texts, held = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0), b.column(1)):
                raw = t.as_buffer().to_pybytes() if t.is_valid else b""
                ids.append(i.as_py())
                texts.append(_counted(terms_of(raw)))
                held += len(raw)
                if len(ids) >= shard_docs or held >= shard_bytes:
                    yield _packed(ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield _packed(ids, texts)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, _INDEX)


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term, qtf) of queries(query_id, text)."""
    small_batches(queries.sparkSession)

    def run(batches):
        use_worker("search")
        for b in batches:
            for q, t in zip(b.column(0), b.column(1)):
                term, n = np.unique(terms_of(t.as_buffer().to_pybytes()), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(term), q.as_py()), pa.int64()), pa.array(term.view(np.int64)), pa.array(n, pa.int64())], names=["query_id", "term", "qtf"])

    one = queries.where("text IS NOT NULL").groupBy(F.col("query_id").cast("long").alias("query_id")).agg(F.min("text").alias("text"))
    return one.select("query_id", F.col("text").cast("binary")).mapInArrow(run, "query_id long, term long, qtf long")


def _spread(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all ranges, one after the other, and which range each is of."""
    n = ends - starts
    return np.repeat(starts - np.cumsum(n) + n, n) + np.arange(n.sum()), np.repeat(np.arange(len(n)), n)


class Shard:
    """A shard made ready for queries with the collection's mean length."""

    def __init__(self, row: dict, mean_length: float):
        self.ids, self.no_id, self.terms, self.offsets = row["ids"], row["no_id"], row["terms"], row["offsets"].astype(np.int64)
        self.docs, self.weights = row["docs"].astype(np.int64), row["tfs"].astype(float)
        norm = (K1 * (1 - B + B * row["lengths"] / mean_length))[self.docs]
        norm += self.weights
        self.weights *= K1 + 1
        self.weights /= norm
        del norm
        self.n, self.df = len(row["lengths"]), np.diff(self.offsets)
        n_blocks = -(-self.n // BLOCK)
        # by document: the terms and weights of each
        by_doc = np.argsort(row["docs"], kind="stable")
        self.doc_terms = np.repeat(np.arange(len(self.terms), dtype=np.int32), self.df)[by_doc]
        self.doc_weights = self.weights[by_doc]
        del by_doc
        self.doc_at = np.concatenate(([0], np.cumsum(np.bincount(self.docs, minlength=self.n))))
        # the longer lists have a place for each document, by block, and block maxima; others are read whole
        long = self.df > max(self.n // SHORT, BLOCK)
        common = np.flatnonzero(long)
        self.row_of = np.full(len(self.terms), -1)
        self.row_of[common] = np.arange(len(common))
        self.dense = np.zeros((len(common), n_blocks, BLOCK), dtype=np.float32)
        for places, t in zip(self.dense.reshape(len(common), n_blocks * BLOCK), common):
            postings = slice(self.offsets[t], self.offsets[t + 1])
            places[self.docs[postings]] = self.weights[postings]
        self.most = self.dense.max(axis=2)
        self.sizes = np.count_nonzero(self.dense, axis=2).astype(np.uint8)  # postings of each block
        short = np.repeat(~long, self.df)
        self.docs, self.weights = row["docs"][short], self.weights[short].astype(np.float32)
        self.offsets = np.concatenate(([0], np.cumsum(np.where(long, 0, self.df))))
        self.asked = np.zeros(len(self.terms))
        self.postings = self.scored = 0  # of all queries' terms; read or scored

    def _read(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What these short lists give to each document, with the last block filled up."""
        n_docs, starts, ends = self.most.shape[1] * BLOCK, self.offsets[terms], self.offsets[terms + 1]
        if not len(terms):
            return np.zeros(n_docs)
        lists = [slice(*x) for x in zip(starts.tolist(), ends.tolist())]  # runs are copied faster than single postings
        docs, given = np.concatenate([self.docs[x] for x in lists]), np.concatenate([self.weights[x] for x in lists])
        given *= np.repeat(weights.astype(np.float32), ends - starts)
        self.scored += len(docs)
        return np.bincount(docs, given, n_docs)

    def _read_blocks(self, rows: np.ndarray, weights: np.ndarray, live: np.ndarray) -> np.ndarray:
        """What these long lists give to the documents of the live blocks."""
        self.scored += int(self.sizes[rows][:, live].sum(dtype=np.int64))
        return np.tensordot(weights.astype(np.float32), self.dense[rows[:, None], live], 1)

    def _of_docs(self, rows: np.ndarray, weights: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """What these long lists give to some documents."""
        given = self.dense[rows[:, None], docs // BLOCK, docs % BLOCK]
        self.scored += int(np.count_nonzero(given))
        return weights @ given

    def _full(self, docs: np.ndarray) -> np.ndarray:
        """Whole scores; a document's terms are always added in the same order."""
        places, which = _spread(self.doc_at[docs], self.doc_at[docs + 1])
        asked = self.asked[self.doc_terms[places]]
        self.scored += int(np.count_nonzero(asked))
        return np.bincount(which, asked * self.doc_weights[places], len(docs))

    def top(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: float = 0.0) -> list[tuple[float, bool, int]]:
        """(-score, whether the id is null, id) of the best k that reach floor, the best first; terms in hash order."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        have = self.terms[at] == terms
        at, weights = at[have], weights[have]
        if not len(at):
            return []
        self.asked[at] = weights
        asked = at
        self.postings += int(self.df[at].sum())
        order = np.argsort(self.df[at], kind="stable")
        at, weights = at[order], weights[order]
        rare = self.row_of[at] < 0
        score = self._read(at[rare], weights[rare])
        rows, weights = self.row_of[at[~rare]], weights[~rare]
        parts = [0]  # of the lists, in the order in which they are read: LISTS, then half as many more as are read
        while parts[-1] < len(rows):
            parts.append(min(len(rows), parts[-1] + parts[-1] // GROWTH + LISTS))
        own = np.zeros((len(parts), len(rows)), dtype=np.float32)
        for i, (start, end) in enumerate(zip(parts, parts[1:])):
            own[i, start:end] = weights[start:end]
        rest = np.cumsum((own @ self.most[rows])[::-1], axis=0)[::-1]  # the block maxima of the lists from each part on
        least = floor
        if not floor:
            hope = (score.reshape(-1, BLOCK) + rest[0][:, None] * HOPE).ravel()[: self.n]
            first = np.argpartition(hope, max(self.n - SEEDS * k, 0))[-SEEDS * k :]
            firsts = score[first] + self._of_docs(rows, weights, first)
            least = np.partition(firsts, len(firsts) - k)[len(firsts) - k] if len(firsts) >= k else 0.0
        for i, (start, end) in enumerate(zip(parts, [*parts[1:], None])):
            bound = score.reshape(-1, BLOCK) + rest[i][:, None]
            pivot = bound >= max(least, 1e-300) * (1 - 1e-4)  # maxima are rounded
            live = pivot.any(axis=1)
            if end is None or not live.any():
                break
            live = np.flatnonzero(live)
            score.reshape(-1, BLOCK)[live] += self._read_blocks(rows[start:end], weights[start:end], live)
            reached = score.reshape(-1, BLOCK)[pivot]
            if len(reached) > k:
                least = max(least, np.partition(reached, len(reached) - k)[len(reached) - k])
        pivots = np.flatnonzero(pivot)
        full = self._full(pivots)
        self.asked[asked] = 0
        good = (full > 0) & (full >= floor)
        hit, full = pivots[good], full[good]
        order = np.lexsort((self.ids[hit], self.no_id[hit], -full))[:k]
        return [(-full[i], bool(self.no_id[hit[i]]), int(self.ids[hit[i]])) for i in order]


def search(docs: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """(query_id, rank, doc_id, score): for each of queries(query_id, text) the best k of
    docs(doc_id, text). Null doc_ids come out as null."""
    scratch = Scratch(docs.sparkSession)
    index = scratch.cut(build_index(docs), maxRecordsPerFile=1)  # else a reader holds all shards of a file at once
    made = sorted({int(f.rsplit("/", 1)[-1].split("-")[1]) for f in index.inputFiles()})  # tasks that made it: a task's shards stay together
    n_first = -(-len(made) // FIRST)
    of_task = F.split("_metadata.file_name", "-")[1].cast("int")  # other files aren't opened
    parts = [(index.where(of_task < made[n_first]), n_first), (index.where(of_task >= made[n_first]), len(made) - n_first)] if n_first < len(made) else [(index, len(made))]
    parts = [x.coalesce(max(1, tasks)) for x, tasks in parts]
    index = index.coalesce(max(1, len(made)))
    n, total = index.select(F.sum("n_docs"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x))).first()
    n, total = n or 0, total or 0
    dfs = F.transform("terms", lambda t, i: F.struct(t.alias("term"), (F.col("offsets")[i + 1] - F.col("offsets")[i]).cast("long").alias("df")))
    df = index.select(F.inline(dfs)).groupBy("term").agg(F.sum("df").alias("df"))
    idf = F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = query_terms(queries).join(df, "term").select("query_id", F.struct("term", (idf * F.col("qtf")).alias("w")).alias("tw"))
    asked = scratch.cut(weighted.groupBy("query_id").agg(F.array_sort(F.collect_list("tw")).alias("tw")))
    n_queries, n_terms = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("tw")), F.lit(0))).first()
    n_blocks = max(1, -(-n_queries // QUERY_BLOCK), -(-n_terms // QUERY_TERMS))
    mean = max(total / n, 1e-9) if n else 1.0
    found = []
    for i in range(n_blocks):  # a pass over the index for each block; what it was sent is given back
        block = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)) == i).select("query_id", "tw.term", "tw.w").toArrow()
        sent, floors = _sent(docs.sparkSession, block), {}
        for j, part in enumerate(parts):
            with batches_of(docs.sparkSession, 1):
                found.append(scratch.cut(_against(part, sent, mean, k, floors)))
            if j < len(parts) - 1:
                floors = _kth(found[-1], k)
        sent.destroy()
    order = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def _sent(spark, block: pa.Table):
    """A block of queries, broadcast: QUERY_BLOCK queries, QUERY_TERMS terms."""
    lists = lambda name: (x.values.to_numpy() for x in block[name])
    qs = [(q, t.view(np.uint64), w) for q, t, w in zip(block["query_id"].to_pylist(), lists("term"), lists("w"))]
    return spark.sparkContext.broadcast([(q, t[o], w[o]) for q, t, w in qs for o in [np.argsort(t)]])


def _kth(found: DataFrame, k: int) -> dict[int, float]:
    """The k-th best score of each query of a block that has so many."""
    kth = found.groupBy("query_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s")).where(F.size("s") >= k)
    return {r[0]: r[1] for r in kth.select("query_id", F.col("s")[k - 1]).collect()}


def _against(index: DataFrame, shared, mean: float, k: int, floors: dict[int, float]) -> DataFrame:
    """(query_id, doc_id, score): the best k of each task's shards for each query of the broadcast
    block, of those that reach the query's floor."""

    def run(batches):
        use_worker("search")
        best = [[] for _ in shared.value]  # of all shards of this task; its k-th score prunes the next shard
        for b in batches:
            for i in range(len(b)):
                row = {c: b.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("lengths", "terms", "offsets", "docs", "tfs")}
                ids = b.column("ids")[i].values
                row |= {"terms": row["terms"].view(np.uint64), "ids": ids.fill_null(0).to_numpy(), "no_id": ids.is_null().to_numpy(zero_copy_only=False)}
                shard = None  # the one before goes first
                shard = Shard(row, mean)
                if not len(shard.terms):
                    continue
                for n, (q, t, w) in enumerate(shared.value):
                    found = shard.top(t, w, k, max(floors.get(q, 0.0), -best[n][-1][0] if len(best[n]) == k else 0.0))
                    if found:
                        best[n] = heapq.nsmallest(k, best[n] + found)
        for (q, _, _), found in zip(shared.value, best):
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([q] * len(found), pa.int64()), pa.array([None if no else i for _, no, i in found], pa.int64()), pa.array([-s for s, _, _ in found], pa.float64())], names=["query_id", "doc_id", "score"])

    columns = index.select("ids", "lengths", "terms", "offsets", "docs", "tfs")
    return columns.mapInArrow(run, "query_id long, doc_id long, score double")
