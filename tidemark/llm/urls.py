"""URL filters from dated lists: entries become validity intervals, captures are joined as of
their fetch time.

A list is a log of dated changes: an entry (a domain, or a host with a path prefix) is added or
removed, with an action. An entry is active from the date it was added, included, to the date of
its next change. A capture meets the entries for its host, for every parent domain and for every
prefix of its path, each as it stood at fetch time. The most specific one decides (a path before
a domain, the longer before the shorter); at equal entries of several lists, allow before block.

The join is an equi-join on the entry with a range condition on time, over distinct (url, time),
so copies of a URL are evaluated once and no entry meets captures it can't match. Keys that most
captures share, as `com`, are dealt over SALTS parts; the list, the smaller side, is in each.

Defined results: a null or unparsable URL, a null time and a capture without an active entry are
allowed, with a null entry; repeated captures keep their rows; repeated changes count once; of
changes of one entry of a list at one time, the removal is last. Hosts compare in lower case,
without a trailing dot, also those of entries; paths keep their case on both sides, as servers
tell them apart; ports, credentials, query and fragment don't count. An empty table gives no rows, a
very long URL is read whole, columns that aren't kept are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import free_names

#: Parts that the captures of one key are dealt over.
SALTS = 16
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)?"


def intervals(changes: DataFrame) -> DataFrame:
    """(list, entry, action, valid_from, valid_to) from changes(list, entry, at, change, action);
    valid_to is null where nothing followed."""
    entry = F.trim("entry")
    host = F.substring_index(entry, "/", 1)
    path = F.substring(entry, F.length(host) + 1, F.length(entry))
    log = changes.select("list", F.concat(F.regexp_replace(F.lower(host), r"\.$", ""), path).alias("entry"), "at", "change", "action")
    log = log.where("entry IS NOT NULL AND at IS NOT NULL").distinct()
    each = W.partitionBy("list", "entry").orderBy("at", (F.col("change") == "remove").cast("int"), "action")
    spans = log.withColumn("valid_to", F.lead("at").over(each)).where("change = 'add' AND (valid_to IS NULL OR valid_to > at)")
    return spans.select("list", "entry", "action", F.col("at").alias("valid_from"), "valid_to")


def host_of(url: Column) -> Column:
    return F.nullif(F.regexp_replace(F.lower(F.regexp_extract(url, _HOST, 1)), r"\.$", ""), F.lit(""))


def keys_of(url: Column) -> Column:
    """Every entry that a URL could match: host, parent domains, host with each path prefix."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    steps = F.filter(F.split(F.regexp_extract(url, _PATH, 1), "/"), lambda s: s != "")
    none = F.array().cast("array<string>")
    paths = F.when(F.size(steps) == 0, none).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.size(steps), F.lit(1))), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, F.lit(1), i), "/"))))
    return F.when(host.isNull(), none).otherwise(F.concat(domains, paths))


def evaluate(captures: DataFrame, changes: DataFrame, *keep: str) -> DataFrame:
    """keep, url, fetched_at, decision, list, entry of each row of captures(url, fetched_at)."""
    asked = captures.where("url IS NOT NULL AND fetched_at IS NOT NULL").select("url", "fetched_at").distinct()
    salt = F.pmod(F.xxhash64("url", "fetched_at"), F.lit(SALTS)).cast("int")
    keyed = asked.select("url", "fetched_at", salt.alias("salt"), F.explode(keys_of(F.col("url"))).alias("entry"))
    spans = intervals(changes).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    active = keyed.join(spans, ["entry", "salt"]).where("fetched_at >= valid_from AND (valid_to IS NULL OR fetched_at < valid_to)")
    rank = F.struct(F.contains("entry", F.lit("/")).cast("int").alias("path"), F.length("entry").alias("n"), (F.col("action") == "allow").cast("int").alias("allow"), F.col("list").alias("list"), F.col("entry").alias("entry"), F.col("action").alias("action"))
    (won,) = free_names(list(keep), "best")
    best = active.groupBy("url", "fetched_at").agg(F.max(rank).alias(won))
    met = captures.select(*keep, "url", "fetched_at").join(best, ["url", "fetched_at"], "left")
    return met.select(*keep, "url", "fetched_at", F.coalesce(F.col(won).getField("action"), F.lit("allow")).alias("decision"), F.col(won).getField("list").alias("list"), F.col(won).getField("entry").alias("entry"))
