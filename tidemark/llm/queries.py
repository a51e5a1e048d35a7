"""The queries opN_<name> of the training-data operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import tokenize
from .collocations import SQL as OP12_SQL
from .collocations import collocations
from .common import table
from .fingerprints import SQL as OP13_SQL
from .fingerprints import fingerprints
from .manifest import SQL as OP11_SQL
from .manifest import verify
from .mixing import mix
from .neardup import classes
from .pages import extract
from .pii import report
from .quality import score
from .rules import judge
from .search import search
from .sharding import shard
from .urls import evaluate, host_of


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules")
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))


def op5_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokenize(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), digests=True)


#: A dated list for the hosts of `pages`: entry, date, change, action, list.
URL_CHANGES = [
    ("spam-farm.example.org", "2024-01-01", "add", "block", "spam"),
    ("spam-farm.example.org", "2024-08-15", "remove", "block", "spam"),
    ("spam-farm.example.org", "2024-10-01", "add", "block", "spam"),
    ("example.net", "2024-03-01", "add", "block", "networks"),
    ("example.net", "2024-05-01", "remove", "block", "networks"),
    ("tionsh.example.net", "2024-04-01", "add", "allow", "exceptions"),
    ("tionsh.example.net/fr", "2024-04-10", "add", "block", "paths"),
    ("ththon.example.com", "2024-06-01", "add", "block", "spam"),
    ("example.com", "2024-11-15", "add", "block", "networks"),
    ("blog.tionble.example.com", "2024-11-20", "add", "allow", "exceptions"),
    ("m.thther.example.org/en", "2024-02-01", "add", "block", "paths"),
    ("m.thther.example.org/en", "2024-12-01", "remove", "block", "paths"),
]
#: `pages` has no fetch time; a hash of the URL stands for one: a day of 2024.
_FETCHED = "CAST(date_add(DATE'2024-01-01', CAST(conv(substring(md5(url), 1, 4), 16, 10) AS INT) % 366) AS STRING)"


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = table(spark, sf_dir, "pages").select("page_id", "url", F.expr(_FETCHED).alias("fetched_at"))
    changes = spark.createDataFrame(URL_CHANGES, "entry string, at string, change string, action string, list string")
    return evaluate(captures, changes, "page_id").withColumn("host", host_of(F.col("url")))


OP8_SQL = f"""
WITH changes(entry, since, change, action, list) AS (VALUES {", ".join(map(str, URL_CHANGES))}),
spans AS (SELECT * FROM (SELECT *, lead(since) OVER (PARTITION BY list, entry ORDER BY since) AS valid_to FROM changes) x WHERE change = 'add'),
captures AS (
  SELECT page_id, url, CAST(DATE '2024-01-01' + CAST(CAST('0x' || substr(md5(url), 1, 4) AS INT) % 366 AS INT) AS VARCHAR) AS fetched_at,
         lower(regexp_extract(url, '^[a-z]+://([^/?#:@]+)', 1)) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*(/[^?#]*)?', 1) AS path FROM pages),
met AS (
  SELECT c.*, s.entry, s.list, s.action, row_number() OVER (PARTITION BY page_id, url ORDER BY contains(s.entry, '/') DESC, length(s.entry) DESC, s.action = 'allow' DESC) AS no
  FROM captures c LEFT JOIN spans s ON c.fetched_at >= s.since AND (s.valid_to IS NULL OR c.fetched_at < s.valid_to)
   AND (c.host = s.entry OR ends_with(c.host, '.' || s.entry) OR starts_with(rtrim(c.host || c.path, '/') || '/', s.entry || '/') AND contains(s.entry, '/')))
SELECT page_id, url, fetched_at, coalesce(action, 'allow') AS decision, list, entry, host FROM met WHERE no = 1
"""


def op9_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    queries = docs.where("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), "text")
    return search(docs, queries).withColumn("score", F.round("score", 6))


def op10_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def queries() -> dict:
    import corpus_pipeline

    return {
        "pipeline": corpus_pipeline.run,
        "op1_mixing": op1_mixing,
        "op2_sharding": op2_sharding,
        "op3_rules": op3_rules,
        "op4_pii": op4_pii,
        "op5_pages": op5_pages,
        "op6_quality": op6_quality,
        "op7_bpe": op7_bpe,
        "op8_urls": op8_urls,
        "op9_search": op9_search,
        "op10_neardup": op10_neardup,
        "op11_manifest": op11_manifest,
        "op12_collocations": op12_collocations,
        "op13_fingerprints": op13_fingerprints,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_urls": OP8_SQL, "op11_manifest": OP11_SQL, "op12_collocations": OP12_SQL, "op13_fingerprints": OP13_SQL}
