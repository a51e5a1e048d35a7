"""Sharding by a hypergeometric communication matrix: a uniform shuffle with exact shard sizes.

Rows are dealt to parts by a hash. How many rows of each part go to each shard is drawn at once,
for all parts, from the multivariate hypergeometric law: the matrix that a uniform permutation of
all rows would have. Each part is permuted on its own and cut at its row of the matrix; the
exchange brings the pieces to their shards, where they are permuted again. Shards differ by one
row at most, and every permutation of the rows is as likely as any other.

Defined results: a null text counts 0 bytes plus 8 and has the CRC of no bytes, 0; equal rows are
dealt one by one and may land apart; an empty table gives no rows; a very long text is one row as
any other; extra columns are ignored. Permutations order by hashes
of the rows, not by their arrival, so a retried task deals alike.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

SEED = 20_240_502
#: Parts: one for so many rows, and so many at most; the matrix has parts x shards numbers.
PART_ROWS, MOST_PARTS = 4_096, 65_536
#: Rows of a shard that one task puts in order.
BLOCK_ROWS = 65_536


def communication_matrix(parts: list[int], shards: int, seed: int) -> np.ndarray:
    """counts[part, shard]: a draw from the law of a uniform permutation; rows sum to the parts,
    columns to the shard sizes, which differ by one at most."""
    rng = np.random.default_rng(seed)
    n = sum(parts)
    left = np.full(shards, n // shards, dtype=np.int64)
    left[: n % shards] += 1
    out = np.zeros((len(parts), shards), dtype=np.int64)
    for i, k in enumerate(parts):
        rest = k
        total = int(left.sum())
        for j in range(shards):  # a multivariate draw, one shard after the other
            total -= int(left[j])
            take = rest if total == 0 else int(_hypergeometric(rng, int(left[j]), total, rest))
            out[i, j] = take
            rest -= take
        left -= out[i]
    return out


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    if draws == 0 or good == 0:
        return 0
    if good + bad < 1_000_000_000:
        return rng.hypergeometric(good, bad, draws)
    return _by_inversion(rng, good, bad, draws)  # beyond numpy's range


def _by_inversion(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """The same law at any size: its weights follow from the mode outward by the ratios of
    neighbours; what lies 16 deviations and 64 away is less than a double can add to their sum."""
    n = good + bad
    var = draws * (good / n) * (bad / n) * (n - draws) / max(n - 1, 1)
    low, high, reach = max(draws - bad, 0), min(good, draws), int(16 * var**0.5) + 64
    mode = min(max((draws + 1) * (good + 1) // (n + 2), low), high)
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype=np.float64)
    ratio = (good - k) * (draws - k) / ((k + 1) * (bad - draws + k + 1))  # of k + 1 to k
    at = mode - first
    weights = np.concatenate([np.cumprod(1 / ratio[:at][::-1])[::-1], [1.0], np.cumprod(ratio[at:])])
    sums = weights.cumsum()
    return first + min(int(np.searchsorted(sums, rng.random() * sums[-1], side="right")), len(sums) - 1)


def shard(docs: DataFrame, shards: int = 24, *, seed: int = SEED, part_rows: int = PART_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row of docs(doc_id, text)."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = cut(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(F.lit(seed), "doc_id", "text").alias("key"),
        )
    )
    n_parts = min(MOST_PARTS, max(1, -(-rows.count() // part_rows)))
    rows = rows.withColumns({"part": F.pmod("key", F.lit(n_parts)).cast("int"), "order": F.xxhash64(F.lit(seed + 1), "key")})
    counts = dict(rows.groupBy("part").count().collect())  # MOST_PARTS rows at most
    matrix = communication_matrix([counts.get(i, 0) for i in range(n_parts)], shards, seed)
    ends = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(matrix.cumsum(axis=1))], "part int, ends array<long>")
    local = W.partitionBy("part").orderBy("order", "key", "doc_id", "size", "text_crc32")
    n_rows = int(sum(counts.values()))
    blocks = max(1, -(-n_rows // (shards * block_rows)))
    dealt = (
        rows.withColumn("at", F.row_number().over(local) - 1)
        .join(F.broadcast(ends), "part")  # MOST_PARTS x shards numbers at most
        .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("at"))))
        # the second permutation: by a new hash, whose leading part names a block of the shard
        .withColumn("order", F.xxhash64(F.lit(seed + 2), "key", "at"))
        .withColumn("block", F.pmod(F.shiftrightunsigned("order", 33), F.lit(blocks)).cast("int"))
        .select("doc_id", "size", "text_crc32", "shard", "block", "order", "key")
    )
    dealt = cut(dealt)
    sizes = dealt.groupBy("shard", "block").count()
    starts = sizes.select(
        "shard", "block", F.coalesce(F.sum("count").over(W.partitionBy("shard").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("start")
    )
    within = W.partitionBy("shard", "block").orderBy("order", "key", "doc_id", "size", "text_crc32")
    return (
        dealt.withColumn("no", F.row_number().over(within) - 1)
        .join(starts, ["shard", "block"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("no")).cast("long").alias("slot"))
    )
