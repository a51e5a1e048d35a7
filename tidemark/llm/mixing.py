"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target number of words. A document's expected copies are its source's target
divided by the source's words: a whole part, which all its documents get, and a fraction, which
pivotal rounding turns into 0 or 1. Two documents of a source trade probability, weighted by
their sizes, until one of them is decided; the other goes on. The sum of size times probability
never changes, so a source's words end within one document of its target, and each document
keeps its expected number of copies. Documents meet in groups of bounded size; each group leaves
one undecided document at most, and these meet again, group by group, in a reduction tree.

Defined results: a null or empty text has size 0 and takes 0 words; null is a source like any
other and comes last; repeated rows count each for itself; an empty table gives no rows; a source
without words has target 0; a very long text counts all its words; extra columns are ignored by
mix and handed on by mixed_documents, whatever they are called. Random draws follow from the rows and the seed alone, so reruns and
retried tasks agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, ceil_div, cut, free_names, ordering

SEED = 20_240_501
_TREE = "rank int, bucket long, doc_id long, key long, size long, base int, p double"


def source_targets(sized: DataFrame, weights=(3.0, 1.0, 2.0), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, rank, n_docs, source_size, target) from (source, size): `share` times all words is
    shared out by weight; no target passes `cap` times its source's words, and what is above goes
    to the others by weight until none is above.

    In the order of cap to weight, the sources that are full come first. If exactly the first i
    are full, the rest gets (total - their caps) / (remaining weight) per unit of weight; the
    right level is the largest of these."""
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    ranked = by_source.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    filled = ranked.withColumns({"weight": weight, "most": F.lit(cap) * F.col("source_size")})
    order = W.orderBy(F.col("most") / F.col("weight"), "rank")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy()
    level = (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    return (
        filled.withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least("most", F.col("weight") * F.col("level")))
        .select("source", "rank", "n_docs", "source_size", "target")
    )


def pivot(sizes: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """p after pairwise trades: all 0 or 1, but for one entry at most. sum(sizes * p) stays."""
    out, held = p.copy(), -1
    draws = rng.random(len(p))
    for i in range(len(p)):
        if not 0 < out[i] < 1:
            continue
        if held < 0:
            held = i
            continue
        a, b = out[held], out[i]
        ratio = sizes[i] / sizes[held]
        up, down = min(1 - a, b * ratio), min(a, (1 - b) * ratio)
        if draws[i] * (up + down) < down:  # the held one rises with a chance that keeps its mean
            a, b, full = a + up, b - up / ratio, up == 1 - a
            a, b = (1.0, b) if full else (a, 0.0)
        else:
            a, b, empty = a - down, b + down / ratio, down == a
            a, b = (0.0, b) if empty else (a, 1.0)
        out[held], out[i] = a, b
        held = held if 0 < a < 1 else i if 0 < b < 1 else -1
    return out


def _round_groups(seed: int, level: int):
    def one(t: pa.Table) -> pa.Table:
        key, doc, size = (t.column(c).combine_chunks().fill_null(0).to_numpy(zero_copy_only=False) for c in ("key", "doc_id", "size"))
        order = np.lexsort((doc, key, -size))  # small ones last: what stays undecided is small; rows that tie are the same
        p = t.column("p").to_numpy()
        rng = np.random.default_rng([seed, level, t.column("rank")[0].as_py(), t.column("bucket")[0].as_py()])
        done = np.empty_like(p)
        done[order] = pivot(size[order].astype(float), p[order], rng)
        return t.set_column(t.schema.get_field_index("p"), "p", pa.array(done))

    return one


def mix(docs: DataFrame, *, weights=(3.0, 1.0, 2.0), share: float = 1.5, cap: float = 2.0, seed: int = SEED, group_rows: int = 4096, fan_in: int = 64) -> DataFrame:
    """(doc_id, key, source, size, source_size, target, copies, taken) for each row of
    docs(doc_id, text, source). key tells apart the rows of a doc_id by their text and source."""
    sized = cut(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64(F.lit(seed), "doc_id", "text", "source").alias("key"),
            F.col("source"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        )
    )
    targets = cut(source_targets(sized, weights, share, cap))
    most = targets.agg(F.max("n_docs")).first()[0] or 0
    t = targets.withColumnRenamed("source", "of_source").withColumn("groups", F.greatest(ceil_div(F.col("n_docs"), group_rows), F.lit(1)))
    mean = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    rows = sized.join(t, sized.source.eqNullSafe(t.of_source)).select(
        "rank", F.pmod("key", "groups").alias("bucket"), "doc_id", "key", "size", F.floor(mean).cast("int").alias("base"), (mean - F.floor(mean)).alias("p")
    )
    #: Documents without words weigh nothing; each draws for itself.
    alone = (F.col("size") == 0) & (F.col("p") > 0)
    draw = F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(1 << 30)) / float(1 << 30)
    rows = rows.withColumn("p", F.when(alone, (draw < F.col("p")).cast("double")).otherwise(F.col("p")))
    groups = -(-most // group_rows)
    open_ = (F.col("p") > 0) & (F.col("p") < 1)
    first = cut(rows.groupBy("rank", "bucket").applyInArrow(_round_groups(seed, 0), _TREE))
    done, rest, level = first.where(~open_), first.where(open_), 0
    while groups > 1:
        groups, level = -(-groups // fan_in), level + 1
        met = cut(rest.withColumn("bucket", F.floor(F.col("bucket") / fan_in)).groupBy("rank", "bucket").applyInArrow(_round_groups(seed, level), _TREE))
        done, rest = done.unionByName(met.where(~open_)), met.where(open_)
    done = done.unionByName(rest.withColumn("p", (draw < F.col("p")).cast("double")))
    decided = done.withColumn("copies", F.col("base") + F.col("p").cast("int"))
    return decided.join(targets, "rank").select(
        "doc_id", "key", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_documents(docs: DataFrame, *, seed: int = SEED, **how) -> DataFrame:
    """docs, each row as often as the mix takes it. The mix decides over narrow rows; texts are
    read again and joined by doc_id and content. Rows equal in these share their copies out."""
    cols = docs.columns
    m_id, m_key, m_sum, m_rows, m_no, m_copies = free_names(cols, "m_id", "m_key", "m_sum", "m_rows", "m_no", "m_copies")
    known = F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias(m_id)  # the key tells null from 0
    plan = mix(docs, seed=seed, **how).groupBy(known, F.col("key").alias(m_key)).agg(F.sum("copies").alias(m_sum), F.count(F.lit(1)).alias(m_rows))
    rows = docs.select("*", known, F.xxhash64(F.lit(seed), "doc_id", "text", "source").alias(m_key))
    met = rows.join(plan.where(F.col(m_sum) > 0), [m_id, m_key])
    met = met.withColumn(m_no, F.row_number().over(W.partitionBy(m_id, m_key).orderBy(*ordering(docs, "doc_id", "text", "source"))))
    met = met.withColumn(m_copies, F.expr(f"`{m_sum}` DIV `{m_rows}` + CAST(`{m_no}` <= `{m_sum}` % `{m_rows}` AS INT)").cast("int"))
    copied = met.where(F.col(m_copies) > 0).withColumn(m_no, F.explode(F.sequence(F.lit(1), F.col(m_copies))))
    return copied.select(*[F.col(f"`{c}`") for c in cols])
