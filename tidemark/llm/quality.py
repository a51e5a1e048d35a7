"""Quality scores from a byte-level convolutional network, in numpy.

The network reads a text's UTF-8 bytes, all of them, in overlapping chunks: 16 learned filters of
six bytes slide over every position; each chunk keeps a filter's maximum. The largest and the mean
of a filter's maxima over all chunks go through one hidden layer to one probability. For scoring,
the filters are folded into tables by pairs of bytes, so a position costs three look-ups.

It is trained in one task, on a bounded sample of labelled rows (SAMPLE_ROWS rows, the least by a
hash of the doc_id) and their whole texts. Rows whose crc32(doc_id as text) mod 5 is 0 are held
out. Training and scoring read texts chunk by chunk, so a very long text takes little memory.

Defined results: null and empty texts are scored like a text of zero bytes; without labelled rows
every score is 0.5; a doc_id with several labels counts by its least one, with several texts by
the least text; null labels are ignored; repeated rows get equal scores; rows with a null doc_id
are held out of training, held_out false; an empty table gives no rows; extra columns are ignored,
whatever they are called, and keep_good hands them on.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_names, small_batches, use_worker

SAMPLE_ROWS = 2_400
THRESHOLD = 0.3
FOLDS = 5
#: Bytes of a chunk, filters, bytes of a filter, numbers that stand for a byte, hidden units.
CHUNK, FILTERS, WIDTH, EMBED, HIDDEN = 256, 16, 6, 10, 16


def _chunks(raw: np.ndarray) -> tuple[np.ndarray, int]:
    """raw, filled up with zeros so that chunks of CHUNK positions cover all; and their number."""
    n = max(1, -(-max(len(raw) - WIDTH + 1, 1) // CHUNK))
    out = np.zeros(n * CHUNK + WIDTH - 1, dtype=np.uint8)
    out[: len(raw)] = raw
    return out, n


@dataclass
class Network:
    embed: np.ndarray  # byte, number
    filters: np.ndarray  # place, number, filter
    bias: np.ndarray  # filter
    hidden: np.ndarray  # 2 * filter, unit
    hidden_bias: np.ndarray
    out: np.ndarray  # unit
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, seed: int = 6) -> Network:
        rng = np.random.default_rng(seed)
        b = np.arange(256)
        kinds = [(b >= 97) & (b <= 122), (b >= 65) & (b <= 90), (b >= 48) & (b <= 57), (b == 32) | (b == 10), b >= 128, (b > 32) & (b < 127) & ~((b >= 48) & (b <= 57)) & ~((b >= 65) & (b <= 90)) & ~((b >= 97) & (b <= 122))]
        embed = rng.normal(0, 0.3, (256, EMBED))
        embed[:, : len(kinds)] += np.array(kinds).T
        return cls(
            embed, rng.normal(0, 0.35, (WIDTH, EMBED, FILTERS)), np.zeros(FILTERS),
            rng.normal(0, 0.25, (2 * FILTERS, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.25, HIDDEN), np.zeros(1),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def tables(self) -> list[np.ndarray]:
        """For each pair of places, filter outputs by pair of bytes (first * 256 + second)."""
        t = np.einsum("be,pef->pbf", self.embed, self.filters)
        pairs = [(t[p][:, None, :] + t[p + 1][None, :, :]).reshape(65536, FILTERS) for p in range(0, WIDTH, 2)]
        pairs[0] = pairs[0] + self.bias
        return [p.astype(np.float32) for p in pairs]

    def head(self, x: np.ndarray) -> np.ndarray:
        """Probability from pooled features."""
        z = np.tanh(x @ self.hidden + self.hidden_bias) @ self.out + self.out_bias[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def responses(tables: list[np.ndarray], raw: np.ndarray, n: int) -> np.ndarray:
    """Filter outputs at n * CHUNK places."""
    pair = raw[:-1].astype(np.uint16) * np.uint16(256) + raw[1:]
    m = n * CHUNK
    out = tables[0].take(pair[:m], axis=0)
    for k, t in enumerate(tables[1:], 1):
        out += t.take(pair[2 * k : 2 * k + m], axis=0)
    return out


def pool(tables: list[np.ndarray], text: bytes) -> np.ndarray:
    """The largest and the mean chunk maximum of each filter, over the whole text."""
    raw, n = _chunks(np.frombuffer(text, dtype=np.uint8))
    most, total = np.full(FILTERS, -np.inf, np.float32), np.zeros(FILTERS)
    for i in range(0, n, 16):  # 16 chunks at a time stay in the cache
        k = min(16, n - i)
        top = responses(tables, raw[i * CHUNK : (i + k) * CHUNK + WIDTH - 1], k).reshape(k, CHUNK, FILTERS).max(axis=1)
        most = np.maximum(most, top.max(axis=0))
        total += np.maximum(top, 0).sum(axis=0)
    return np.concatenate((np.maximum(most, 0), total / n))


def _tops(tables: list[np.ndarray], raw: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each chunk's maximum of each filter, and the place in raw where it is."""
    top, place = np.empty((n, FILTERS), np.float32), np.empty((n, FILTERS), np.int64)
    for i in range(0, n, 64):
        k = min(64, n - i)
        y = responses(tables, raw[i * CHUNK : (i + k) * CHUNK + WIDTH - 1], k).reshape(k, CHUNK, FILTERS)
        at = y.argmax(axis=1)
        top[i : i + k] = np.take_along_axis(y, at[:, None, :], axis=1)[:, 0, :]
        place[i : i + k] = at + np.arange(i, i + k)[:, None] * CHUNK
    return top, place


def train(texts: list[bytes], labels: np.ndarray, epochs: int = 8, rate: float = 0.01, batch: int = 48, decay: float = 1e-4, seed: int = 6) -> Network:
    """Adam on the log loss; a maximum passes its gradient to the place where it was."""
    net = Network.fresh(seed)
    rng = np.random.default_rng(seed)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    net.out_bias[0] = np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))
    padded = [_chunks(np.frombuffer(t, dtype=np.uint8)) for t in texts]
    step, places = 0, np.arange(WIDTH)
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        lr = rate * (1 - epoch / epochs)
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            tables, x, windows, owners, tops, firsts = net.tables(), [], [], [], [], []
            for j, i in enumerate(own):
                raw, n = padded[i]
                top, place = _tops(tables, raw, n)
                windows.append(raw[place[:, :, None] + places])
                owners.append(np.full(n, j))
                tops.append(top)
                first = np.zeros((n, FILTERS), dtype=bool)
                first[top.argmax(axis=0), np.arange(FILTERS)] = True
                firsts.append(first)
                x.append(np.concatenate((np.maximum(top.max(axis=0), 0), np.maximum(top, 0).mean(axis=0))))
            x, windows, owners, tops, firsts = np.array(x), np.concatenate(windows), np.concatenate(owners), np.concatenate(tops), np.concatenate(firsts)
            h = np.tanh(x @ net.hidden + net.hidden_bias)
            p = 1 / (1 + np.exp(-np.clip(h @ net.out + net.out_bias[0], -30, 30)))
            dz = (p - labels[own]) / len(own)
            dh = np.outer(dz, net.out) * (1 - h**2)
            dx = dh @ net.hidden.T
            sizes = np.bincount(owners, minlength=len(own))
            g = (dx[owners, :FILTERS] * firsts + dx[owners, FILTERS:] / sizes[owners][:, None]) * (tops > 0)  # chunk, filter
            d_filters, d_embed = np.zeros_like(net.filters), np.zeros_like(net.embed)
            for i in range(0, len(g), 1_024):
                part, own_g = windows[i : i + 1_024], g[i : i + 1_024]
                d_filters += np.einsum("cf,cfpe->pef", own_g, net.embed[part])  # chunk, filter, place, number
                back = np.einsum("cf,pef->cfpe", own_g, net.filters).reshape(-1, EMBED)
                for e in range(EMBED):
                    d_embed[:, e] += np.bincount(part.ravel(), back[:, e], 256)
            grads = [d_embed, d_filters, g.sum(axis=0), x.T @ dh, dh.sum(axis=0), h.T @ dz, np.array([dz.sum()])]
            step += 1
            for q, d, (m, v) in zip(net.parameters(), grads, state):
                d = d + decay * q
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                q -= lr * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, text, quality) of so many labelled rows, not held out."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").where(~held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    met = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(some), "doc_id")  # `rows` rows
    return met.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").alias("quality"))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Network | None:
    """The network, trained in one task; None without labelled rows."""

    def run(batches):
        use_worker("quality")
        sample = sorted((d, t or "", q) for b in batches for d, t, q in zip(*(c.to_pylist() for c in b.columns)))
        if sample:
            net = train([t.encode() for _, t, _ in sample], np.array([float(q) for *_, q in sample]))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)], pa.binary())], names=["net"])

    sample = labelled_sample(docs, labels, rows).select("doc_id", "text", F.col("quality").cast("double"))
    got = sample.coalesce(1).mapInArrow(run, "net binary").first()  # some 40 kB
    return pickle.loads(got[0]) if got else None


def score(docs: DataFrame, labels: DataFrame, *keep: str, threshold: float = THRESHOLD) -> DataFrame:
    """keep, held_out, score, predicted of each row of docs(doc_id, text), by labels(doc_id, quality)."""
    small_batches(docs.sparkSession)
    net = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # some 40 kB
    (hidden,) = free_names([*keep, "held_out"], "_text")
    rows = docs.select(*keep, F.coalesce(held_out(), F.lit(False)).alias("held_out"), F.col("text").cast("binary").alias(hidden))
    n_kept = len(keep) + 1

    def run(batches):
        use_worker("quality")
        own = shared.value
        tables = own.tables() if own else None
        for b in batches:
            if own:
                x = np.array([pool(tables, t.as_buffer() if t.is_valid else b"") for t in b.column(n_kept)]).reshape(-1, 2 * FILTERS)
                p = own.head(x)
            else:
                p = np.full(len(b), 0.5)
            out = [pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays([*b.columns[:n_kept], *out], names=[*(f.name for f in kept), "score", "predicted"])

    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

    kept = rows.drop(hidden).schema
    return rows.mapInArrow(run, StructType([*kept, StructField("score", DoubleType()), StructField("predicted", IntegerType())]))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that are scored `threshold` or more, with their columns."""
    small_batches(docs.sparkSession)
    net = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    at = docs.columns.index("text")

    def run(batches):
        use_worker("quality")
        own = shared.value
        tables = own.tables() if own else None
        for b in batches:
            if own:
                x = np.array([pool(tables, t.as_py().encode() if t.is_valid else b"") for t in b.column(at)]).reshape(-1, 2 * FILTERS)
                b = b.filter(pa.array(own.head(x) >= threshold))
            yield b

    return docs.mapInArrow(run, docs.schema)
