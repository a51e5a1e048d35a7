"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share. The cluster names it in
    spark.checkpoint.dir; where that is unset, as in tests, one is made."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at is None:
        at = tempfile.mkdtemp(prefix="tidemark-checkpoints-")
        spark.conf.set("spark.checkpoint.dir", at)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(at)
    return at


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it from there: what follows doesn't compute it
    again, also when executors are lost. Only narrow frames are cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Scratch:
    """Tables of one call in the shared folder: as cut(), but compressed, and each can be dropped
    when nothing reads it any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.at, self.n = spark, f"{shared_dir(spark)}/tidemark-{uuid.uuid4().hex}", 0

    def cut(self, df: DataFrame, **options) -> DataFrame:
        self.n += 1
        path = f"{self.at}/{self.n}"
        df.write.options(**options).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path
        return out

    def renamed(self, table: DataFrame, **names: str) -> DataFrame:
        """The same table with these columns, under new names."""
        out = table.select(*[F.col(a).alias(b) for a, b in names.items()])
        out._scratch = table._scratch
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            remove(self.spark, t._scratch)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever store its path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def numbered(scratch: Scratch, df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """df with idx (0, 1, ... within its group, by order), n (rows of the group) and, where there
    are group columns, g (number of the group, by its columns) and n_g (number of groups). Nulls come
    first and are one group; rows that tie in all of `order` get their numbers as they come.

    Rows are dealt by ranges of (group, order), so a large group spreads over many tasks. A row's
    place in its range is kept in a table; what lies before it is a sum over the ranges of its group,
    of which there are no more than tasks. df should be narrow: its rows are shuffled and written."""
    by = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    at = scratch.cut(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()))
    ranges = at.groupBy(F.shiftright("at", 33).alias("r"), *[F.col(c).alias(f"r_{c}") for c in group]).agg(F.min("at").alias("r_from"), F.count(F.lit(1)).alias("r_rows"))
    same = W.partitionBy(*[f"r_{c}" for c in group])
    ranges = ranges.withColumns(
        {
            "r_before": F.coalesce(F.sum("r_rows").over(same.orderBy("r").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
            "n": F.sum("r_rows").over(same),
        }
    )
    made = []
    if group:
        groups = numbered(scratch, ranges.select(*[F.col(f"r_{c}").alias(f"g_{c}") for c in group]).distinct(), [], [f"g_{c}" for c in group])
        groups = groups.withColumnsRenamed({"idx": "g", "n": "n_g"})
        met = [F.col(f"r_{c}").eqNullSafe(F.col(f"g_{c}")) for c in group]
        ranges, made = ranges.join(groups, met), ["g", "n_g"]
    met = [F.shiftright("at", 33) == F.col("r"), *[F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in group]]
    return at.join(ranges, met).select(*df.columns, (F.col("r_before") + F.col("at") - F.col("r_from")).alias("idx"), "n", *made)


def ceil_div(a, b: int):
    return F.ceil(a / F.lit(b)).cast("long")


def free_names(taken: list[str], *names: str) -> list[str]:
    """The names, each with underscores in front until no column is called so in any case."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def ordering(df: DataFrame, *but: str) -> list:
    """What puts rows in order that are alike in some columns: all the others, in a form that sorts."""
    skip = {c.lower() for c in but}
    plain = lambda f: not any(x in f.dataType.simpleString() for x in ("map<", "variant", "interval", "geo"))
    return [F.col(f"`{f.name}`") if plain(f) else F.to_json(F.struct(F.col(f"`{f.name}`").alias("v"))) for f in df.schema if f.name.lower() not in skip] or [F.lit(0)]


#: Rows of a batch of texts on its way to Python and back.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of BATCH_ROWS rows at most: Spark's default of 10,000 rows costs
    each task some hundred MB in both processes. A smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """What runs meanwhile goes to Python in batches of so many rows: for rows of some MB each."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


_held: dict[str, object] = {}


def use_worker(name: str, release=None) -> None:
    """Called in a Python worker, which serves one stage after the other: what other operators keep
    between their tasks (caches) is given back. release() is kept for the next one to call."""
    for other in [k for k in _held if k != name]:
        _held.pop(other)()
    if release is not None:
        _held[name] = release
