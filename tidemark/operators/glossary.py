"""Terms of a glossary in texts, by joins: the glossary is a table, of any length.

A text becomes tokens: words, single spaces, other characters. A term is a run of tokens, so it is
found by equality with the runs of a text that are as long as some term; a text's run also counts
without an s or x at its end. Nothing of the glossary is in the plan but the lengths that terms have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import normalize

_TOKEN = r"(?U)\w+|\s|."
#: Stands between the tokens of a run; no text has it.
_BETWEEN = "\x00"


def _tokens(normalized: Column) -> Column:
    return F.regexp_extract_all(normalized, F.lit(_TOKEN), 0)


def _key(tokens: Column) -> Column:
    return F.array_join(tokens, _BETWEEN)


def prepared(glossary: DataFrame) -> DataFrame:
    """(term, fr, en, n_tokens, n_chars) of glossary(fr, en), a row a term; empty terms are left out."""
    tokens = _tokens(normalize(F.col("fr")))
    terms = glossary.select("fr", "en", tokens.alias("t")).where(F.size("t") > 0)
    return terms.select(_key(F.col("t")).alias("term"), "fr", "en", F.size("t").alias("n_tokens"), F.length("fr").alias("n_chars"))


def occurrences(texts: DataFrame, glossary: DataFrame, keys, text: str = "text") -> DataFrame:
    """(keys, at, n_tokens, n_chars, fr, en): each place of texts(keys, text) where a term stands, by the number of
    its first token in the normalised text. Terms stand as whole words, in the singular or with s or x
    (J15, F06)."""
    terms = prepared(glossary)
    lengths = sorted(r.n_tokens for r in terms.select("n_tokens").distinct().collect())  # a few small numbers
    tokens = texts.select(*keys, _tokens(normalize(F.col(text))).alias("t"))
    runs = None
    word = lambda i: F.get("t", i).rlike(r"(?U)^\w")
    for n in lengths:
        at = F.explode(F.sequence(F.lit(0), F.size("t") - n)).alias("at")
        one = tokens.where(F.size("t") >= n).select(*keys, F.lit(n).alias("n"), "t", at)
        one = one.where(word(F.col("at")) & word(F.col("at") + (n - 1)))  # where a term's borders are
        one = one.select(*keys, "at", _key(F.slice("t", F.col("at") + 1, F.col("n"))).alias("run"))
        runs = one if runs is None else runs.unionByName(one)
    if runs is None:
        return texts.limit(0).select(*keys, F.lit(0).alias("at"), F.lit(0).alias("n_tokens"), F.lit(0).alias("n_chars"), F.lit("").alias("fr"), F.lit("").alias("en"))
    singular = F.when(F.col("run").rlike(r"\w[sx]$"), F.expr("left(run, length(run) - 1)"))
    forms = runs.select(*keys, "at", F.explode(F.array_compact(F.array("run", singular))).alias("term"))
    return forms.join(terms, "term").select(*keys, "at", "n_tokens", "n_chars", "fr", "en")


def relevant(texts: DataFrame, glossary: DataFrame, keys, text: str = "text") -> DataFrame:
    """texts with `terms`: the glossary's terms that each has, as sorted structs (fr, en); none: empty."""
    found = occurrences(texts, glossary, keys, text).groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct("fr", "en"))).alias("terms"))
    none = F.array().cast("array<struct<fr:string,en:string>>")
    return texts.join(found, list(keys), "left").withColumn("terms", F.coalesce("terms", none))


def translated(texts: DataFrame, glossary: DataFrame, keys, text: str = "text") -> DataFrame:
    """texts with `translated`: the normalised text with its terms replaced, the longest first and of equal
    ones the first; what is replaced is not looked at again. Null where nothing changes (F05)."""
    place = F.struct((-F.col("n_chars")).alias("longest"), "at", "n_tokens", F.lower("en").alias("en"))
    found = occurrences(texts, glossary, keys, text).groupBy(*keys).agg(F.array_sort(F.collect_set(place)).alias("found"))
    apart = lambda a, b: (a["at"] + a["n_tokens"] <= b["at"]) | (b["at"] + b["n_tokens"] <= a["at"])
    taken = F.aggregate("found", F.slice("found", 1, 0), lambda acc, x: F.when(F.forall(acc, lambda a: apart(a, x)), F.concat(acc, F.array(x))).otherwise(acc))
    met = texts.join(found.select(*keys, taken.alias("taken")), list(keys), "left")
    tokens = F.transform(_tokens(normalize(F.col(text))), lambda t, i: F.struct(t.alias("t"), i.alias("i")))

    def put(x: Column) -> Column:
        here = F.filter("taken", lambda k: (k["at"] <= x["i"]) & (x["i"] < k["at"] + k["n_tokens"]))
        first = F.get(here, F.lit(0))
        return F.when(F.size(here) == 0, x["t"]).when(first["at"] == x["i"], first["en"]).otherwise("")

    out = F.array_join(F.transform(tokens, put), "")
    return met.withColumn("translated", F.when(F.col("taken").isNotNull(), F.nullif(out, normalize(F.col(text))))).drop("taken")


def missing(pairs: DataFrame, glossary: DataFrame, keys, fr: str = "text_fr", en: str = "text_en") -> DataFrame:
    """pairs with `missing`: English terms whose French ones a text has and that don't begin any word of its
    translation, sorted (F06)."""
    found = occurrences(pairs, glossary, keys, fr).select(*keys, F.col("en").alias("_term")).distinct()
    met = found.join(pairs.select(*keys, F.regexp_replace(F.lower(F.col(en)), r"(?U)\s+", " ").alias("_en")), list(keys))
    plain = F.regexp_replace(F.trim(F.lower("_term")), r"(?U)\s+", " ")
    begins = F.regexp_replace("_en", r"(?U)\b(?=\w)", _BETWEEN)  # marks where words begin
    words = F.split(begins, _BETWEEN)
    there = F.exists(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.array_join(F.slice(words, i + 1, F.size(F.split(plain, " ")) * 2), "").startswith(plain))
    lost = met.where(~there).groupBy(*keys).agg(F.array_sort(F.collect_set("_term")).alias("missing"))
    return pairs.join(lost, list(keys), "left").withColumn("missing", F.coalesce("missing", F.array().cast("array<string>")))
