"""Running values over ordered groups of any size.

A window gives each group to one task. Here rows are dealt by ranges of (keys, order), so that a
large group lies in many blocks. Each block of a group is summed up in one row; what lies before a
block is a running value over these rows; it is added to the running value inside the block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..storage import kept


def in_blocks(df: DataFrame, keys, order) -> DataFrame:
    """df with _at, its place in the order of (keys, order), and _block, of which a group has many."""
    by = [F.col(c).asc_nulls_first() for c in (*keys, *order)]
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    return kept(placed).withColumn("_block", F.shiftright("_at", 33))


def scan(df: DataFrame, keys, order, *, sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None, lags: dict[str, Column] | None = None) -> DataFrame:
    """df and, by group and order: sums, of all rows before (0 for the first); lasts, the last value up
    to the row that isn't null; lags, the value of the row before. Nulls come first, and null keys
    are one group. The order must be total where the values need it to be."""
    sums, lasts, lags = sums or {}, lasts or {}, lags or {}
    given = {f"_in_{name}": value for name, value in (sums | lasts | lags).items()}
    rows = in_blocks(df.withColumns(given), keys, order)
    value = lambda name: F.col(f"_in_{name}")
    by_block = rows.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_block").alias("_b")).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(value(n)).alias(f"_of_{n}") for n in sums],
        *[F.max_by(F.struct(value(n).alias("v")), F.when(value(n).isNotNull(), F.col("_at"))).alias(f"_of_{n}") for n in lasts],
        *[F.max_by(F.struct(value(n).alias("v")), "_at").alias(f"_of_{n}") for n in lags],
    )
    blocks = W.partitionBy(*[f"_k_{k}" for k in keys]).orderBy("_b")
    before = blocks.rowsBetween(W.unboundedPreceding, -1)
    carried = [F.sum(f"_of_{n}").over(before).alias(f"_before_{n}") for n in sums]
    carried += [F.last(f"_of_{n}", ignorenulls=True).over(before).alias(f"_before_{n}") for n in lasts]
    carried += [F.lag(f"_of_{n}").over(blocks).alias(f"_before_{n}") for n in lags]
    carry = by_block.select(*[f"_k_{k}" for k in keys], "_b", *carried)
    met = rows.join(carry, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_block") == F.col("_b")])
    inside = W.partitionBy(*keys, "_block").orderBy("_at")
    earlier, so_far = inside.rowsBetween(W.unboundedPreceding, -1), inside.rowsBetween(W.unboundedPreceding, 0)
    out = {n: F.coalesce(F.sum(value(n)).over(earlier), F.lit(0)) + F.coalesce(f"_before_{n}", F.lit(0)) for n in sums}
    out |= {n: F.coalesce(F.last(value(n), ignorenulls=True).over(so_far), F.col(f"_before_{n}")["v"]) for n in lasts}
    out |= {n: F.coalesce(F.lag(F.struct(value(n).alias("v"))).over(inside), F.col(f"_before_{n}"))["v"] for n in lags}
    return met.select(*df.columns, *[v.alias(n) for n, v in out.items()])


def group_begins(t: pa.Table, keys) -> np.ndarray:
    """Whether each row of a table in order of its keys is the first of its group; nulls are one group."""
    new = np.zeros(len(t), dtype=bool)
    new[:1] = True
    for c in keys:
        x = t[c].combine_chunks()
        before, now = x.slice(0, len(x) - 1), x.slice(1)
        differs = pc.fill_null(pc.not_equal(before, now), pc.not_equal(pc.is_null(before), pc.is_null(now)))
        new[1:] |= differs.to_numpy(zero_copy_only=False)
    return new
