"""Merkle manifest of a dataset, with proofs by lookups of coordinates.

A row is a leaf: the digest of its columns. The leaves of a source, in the order of doc_id, are
hashed by runs of 16, these digests again, up to the source's subroot; subroots make the root in the
same way. All digests stand in a node table under (tree, level, idx). A leaf that proves itself
needs no tree in memory: from its index and its tree's size follow the coordinates of the siblings
on its way up; they are exploded, joined with the node table, put in order and concatenated, and
the fold over them gives the root again.

The nodes near a root are siblings on every leaf's way. To keep the join free of such hot keys, a
row explodes the coordinates of `span` levels only and takes what lies above from its ancestor,
which got it in the same way, once for all below it: a node is asked for by 16 ** span rows at most.

Defined results: a null column is `-` in a leaf; null doc_ids come first in their source, rows with
one doc_id by their digest; repeated rows are leaves of their own; null is a source like any other,
before all others; of an empty table nothing comes out; a very long text is hashed whole; a leaf
that is alone in its source is its subroot, and a lone subroot is the root; extra columns are
ignored, whatever they are called. Everything runs in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ceil_div, numbered

RUN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(values: Column) -> Column:
    return F.sha2(values, 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(**changed: Column) -> Column:
    """The digest of a row's FIELDS, some of them changed."""
    return digest(F.concat(*[field(changed.get(c, F.col(c))) for c in FIELDS]))


def _heights(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // RUN), levels + 1
    return levels


def grow(scratch: Scratch, leaves: DataFrame, most: int) -> list[DataFrame]:
    """Node tables (tree, idx, n, hash), one a level from `leaves` on; n counts the tree's nodes of
    that level, and a tree ends at the level where it is 1. most: the leaves of the largest tree."""
    levels = [leaves]
    for _ in range(_heights(most)):
        run = F.floor(F.col("idx") / RUN).cast("long")
        parts = F.transform(F.sort_array(F.collect_list(F.struct("idx", "hash"))), lambda x: x["hash"])
        up = levels[-1].where("n > 1").groupBy("tree", run.alias("idx")).agg(F.first("n").alias("n"), digest(F.array_join(parts, "")).alias("hash"))
        levels.append(scratch.cut(up.select("tree", "idx", ceil_div(F.col("n"), RUN).alias("n"), "hash")))
    return levels


def _siblings(nodes: DataFrame, span: int) -> DataFrame:
    """nodes and (level, at, want): for each level from theirs on, as long as there are siblings' runs,
    the index of the ancestor there, and of each of its siblings (null: it has none)."""
    level = F.explode(F.sequence(F.lit(0), F.lit(span - 1))).alias("level")
    rows = nodes.select("*", level)
    size, at = F.col("n"), F.col("idx")
    for k in range(1, span):
        size = F.when(F.col("level") >= k, ceil_div(size, RUN)).otherwise(size)
        at = F.when(F.col("level") >= k, F.floor(at / RUN).cast("long")).otherwise(at)
    rows = rows.withColumns({"size": size, "at": at}).where("size > 1")
    first = (F.floor(F.col("at") / RUN) * RUN).cast("long")
    run = F.sequence(first, F.least(first + RUN, F.col("size")) - 1)
    return rows.select("*", F.explode_outer(F.filter(run, lambda j: j != F.col("at"))).alias("want")).drop("size")


def _climb(levels: list[DataFrame], base: int, span: int, above: DataFrame, own: DataFrame) -> DataFrame:
    """own(tree, idx, n, ...) and what `above` carries, with path: (left, right) of each level up to
    the root, siblings' digests concatenated. own are nodes of level `base` with siblings;
    above(tree, idx, path, ...) are those of level base + span, or a smaller tree's root."""
    table = None
    for k, nodes in enumerate(levels[base : base + span]):
        one = nodes.select(F.col("tree").alias("in_tree"), F.lit(k).alias("in_level"), F.col("idx").alias("in_idx"), F.unhex("hash").alias("found"))
        table = one if table is None else table.unionByName(one)
    coordinates = _siblings(own.select("tree", "idx", "n"), span)
    looked_up = coordinates.join(table, [F.col("tree") == F.col("in_tree"), F.col("level") == F.col("in_level"), F.col("want") == F.col("in_idx")], "left")
    block = F.floor(F.col("idx") / RUN**span).cast("long").alias("block")
    sibling = F.struct("level", "at", "want", "found").alias("sibling")
    extra = [c for c in own.columns if c not in ("tree", "idx", "n")]
    asked = looked_up.select("tree", block, "idx", sibling, *[F.lit(None).cast(own.schema[c].dataType).alias(c) for c in extra])
    mine = own.select("tree", block, "idx", F.lit(None).cast(asked.schema["sibling"].dataType).alias("sibling"), *extra)
    # dealt by blocks: a node's rows meet, and then their ancestor's path, with one shuffle
    met = asked.unionByName(mine).repartition("tree", "block").groupBy("tree", "block", "idx")
    met = met.agg(F.sort_array(F.collect_list("sibling")).alias("found"), *[F.max(c).alias(c) for c in extra])

    def side(k: Column, before: bool) -> Column:
        of = F.filter("found", lambda x: (x["level"] == k) & ((x["want"] < x["at"]) if before else (x["want"] > x["at"])))
        return F.array_join(F.transform(of, lambda x: F.lower(F.hex(x["found"]))), "")

    steps = F.transform(F.array_distinct(F.transform("found", lambda x: x["level"])), lambda k: F.struct(side(k, True).alias("left"), side(k, False).alias("right")))
    carried = [c for c in above.columns if c not in ("tree", "idx", "path")]
    up = above.select(F.col("tree").alias("up_tree"), F.col("idx").alias("up_idx"), F.col("path").alias("up_path"), *carried)
    out = met.join(up, [F.col("tree") == F.col("up_tree"), F.col("block") == F.col("up_idx")])
    return out.select("tree", "idx", *extra, F.concat(steps, "up_path").alias("path"), *carried)


def _paths(scratch: Scratch, levels: list[DataFrame], roots: DataFrame, span: int, own: DataFrame) -> DataFrame:
    """own(tree, idx, n, ...), the leaves, with path and what roots(tree, idx, path, height, ...) carry:
    each tree's root, the path from there on, and the level where the tree ends."""
    path = roots
    for base in reversed(range(span, max(len(levels) - 1, 1), span)):
        nodes = levels[base].where("n > 1").select("tree", "idx", "n")
        path = scratch.cut(_climb(levels, base, span, path, nodes).unionByName(path.where(F.col("height") <= base)))
    alone = own.where("n = 1").join(roots.where("height = 0").drop("idx"), "tree")
    return _climb(levels, 0, span, path, own.where("n > 1")).unionByName(alone.drop("n")).drop("height")


def _tops(levels: list[DataFrame]) -> DataFrame:
    """(tree, hash, height): each tree has one level with a single node."""
    tops = [nodes.where("n = 1").select("tree", "hash", F.lit(k).alias("height")) for k, nodes in enumerate(levels)]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings give."""
    return F.aggregate(path, start, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def proof(path: Column) -> Column:
    """All siblings' digests from the leaf to the root, concatenated."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def manifest(docs: DataFrame, *, also: Column | None = None, span: int = 2) -> DataFrame:
    """(doc_id, source, leaf, also, subroot, root, path) for each row of docs(FIELDS). path is an array of
    (left, right), from the leaf up. also: a digest that a row has beside its leaf, such as that of a
    copy in question, to be folded along the same path (default: the leaf)."""
    spark, mine = docs.sparkSession, leaf()
    scratch = Scratch(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), mine.alias("hash"), (mine if also is None else also).alias("also"))
    leaves = scratch.cut(numbered(scratch, rows, ["source"], ["doc_id", "hash"]).withColumnRenamed("g", "tree"))
    most, sources = leaves.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.max("n_g"), F.lit(0))).first()
    trees = grow(scratch, leaves.select("tree", "idx", "n", "hash"), most)
    subroots = scratch.cut(_tops(trees))
    over = grow(scratch, subroots.select(F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(sources).cast("long").alias("n"), "hash"), sources)
    end = _tops(over).select("tree", F.lit(0).cast("long").alias("idx"), F.array().cast("array<struct<left:string,right:string>>").alias("path"), "height", F.col("hash").alias("root"))
    above = _paths(scratch, over, end, span, over[0].select("tree", "idx", "n")).select(F.col("idx").alias("of"), "path", "root")
    met = subroots.join(above, F.col("tree") == F.col("of"))
    roots = scratch.cut(met.select("tree", F.lit(0).cast("long").alias("idx"), "path", "height", "root", F.col("hash").alias("subroot")))
    own = leaves.select("tree", "idx", "n", "doc_id", "source", F.col("hash").alias("leaf"), "also")
    return _paths(scratch, trees, roots, span, own).select("doc_id", "source", "leaf", "also", "subroot", "root", "path")


def tampered() -> Column:
    """The leaf of a row whose text's A-Z are lower-cased where 5 divides the crc32 of its doc_id."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return F.when(hit, leaf(text=F.translate("text", UPPER, LOWER))).otherwise(leaf())


def verify(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): each row's copy, some of them
    tampered with, is held against the manifest of the rows as they are."""
    rows = manifest(docs, also=tampered(), **how)
    out = rows.select("doc_id", "leaf", "subroot", "root", digest(proof(F.col("path"))).alias("proof_sha256"), fold(F.col("also"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: verify() in DuckDB's SQL. CRC-32 is a fold over a table of 256 values, made from its polynomial.
SQL = """
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
marked AS (
  SELECT d.*, '-' AS none, doc_id IS NOT NULL AND xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::UBIGINT),
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT) % 5 = 0 AS hit FROM documents d, crc),
headed AS (
  SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, none) || coalesce(strlen(source) || ':' || source, none) || coalesce(strlen(lang) || ':' || lang, none)
         || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, none) AS head FROM marked),
hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, none)) AS leaf,
         CASE WHEN hit THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), none)) END AS other FROM headed),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER same - 1 AS idx, count(*) OVER (PARTITION BY source) AS n
  FROM hashed WINDOW same AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf)),
nodes AS (
  SELECT tree, 0 AS level, idx, n, leaf AS hash FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 16, any_value(n + 15) // 16, sha256(string_agg(hash, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 16),
subroots AS (SELECT tree AS idx, hash, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, idx, n, hash FROM subroots
  UNION ALL
  SELECT level + 1, idx // 16, any_value(n + 15) // 16, sha256(string_agg(hash, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY level, idx // 16),
steps AS (
  SELECT l.tree, l.idx, s.level, string_agg(s.hash, '' ORDER BY s.idx) FILTER (s.idx < l.idx >> (4 * s.level)) AS before, string_agg(s.hash, '' ORDER BY s.idx) FILTER (s.idx > l.idx >> (4 * s.level)) AS after
  FROM leaves l JOIN nodes s ON s.tree = l.tree AND s.n > 1 AND s.idx >> 4 = l.idx >> (4 * s.level + 4) GROUP BY ALL),
upper_steps AS (
  SELECT l.idx AS tree, s.level, string_agg(s.hash, '' ORDER BY s.idx) FILTER (s.idx < l.idx >> (4 * s.level)) AS before, string_agg(s.hash, '' ORDER BY s.idx) FILTER (s.idx > l.idx >> (4 * s.level)) AS after
  FROM subroots l JOIN tops s ON s.n > 1 AND s.idx >> 4 = l.idx >> (4 * s.level + 4) GROUP BY ALL),
low AS (SELECT tree, idx, list(coalesce(before, '') || '|' || coalesce(after, '') ORDER BY level) AS path FROM steps GROUP BY ALL),
high AS (SELECT tree, list(coalesce(before, '') || '|' || coalesce(after, '') ORDER BY level) AS path FROM upper_steps GROUP BY ALL),
ways AS (
  SELECT l.doc_id, l.leaf, coalesce(l.other, l.leaf) AS start, r.hash AS subroot, (SELECT hash FROM tops WHERE n = 1) AS root, coalesce(low.path, []) || coalesce(high.path, []) AS path
  FROM leaves l JOIN subroots r ON r.idx = l.tree LEFT JOIN low ON low.tree = l.tree AND low.idx = l.idx LEFT JOIN high ON high.tree = l.tree),
folded AS (
  SELECT *, sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256, list_reduce([start] || path, lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) AS folded_root FROM ways)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""
