"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Every text gets counts (words, symbols, repeated lines, repeated words). Their ratios are
summarised by one sketch per language and source: counts of values in buckets whose borders grow by
a constant factor, so that a quantile is right within a hundredth of its value. Such sketches are
merged by adding counts: those of a language's sources make the language's, those of languages make
the whole. A group is judged by its own sketch and PRIOR rows' worth of its language's, which
has as many of the whole: a small group leans on its language, and a large one stands for itself,
without a size at which that turns. All counts are whole numbers, so reruns agree.

A ratio is out of line when it passes its group's upper fence: a high quantile and some times its
distance to the median. Where the values have no spread, a fence is still as wide as a few of what is
counted in a text of the group's median length. A fence doesn't rise above a ceiling, so that a
group full of junk can't make junk normal. Texts are then joined with their group's fences and
filtered. Everything runs in the JVM; lambdas see a text's words once.

Defined results: a null or empty text has 0 in every count and fails the base rule; null
languages and sources are groups of their own; repeated rows count each for itself; values that
tie with a fence pass; a very long text is read whole; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACE, cut

WORD_START = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30  # of the base rule: words, percent
#: Rows of the language's sketch that a group's own is mixed with.
PRIOR = 20
#: Borders of buckets grow by this factor.
GROWTH = 1.02
#: ratio: (what it is a share of, percent, spread, least, ceiling). The fence is the value under which so
#: many percent lie, and spread times its distance to the median, but room for `least` of what is
#: counted in a text of median length. Symbols are in few texts but junk, which the percentage leaves out.
RATIOS = {
    "symbol_ratio": ("n_words", 90, 6.0, 3, 0.25),  # symbols to words
    "dup_line_ratio": ("n_lines", 99, 1.5, 2, 0.7),  # repeated lines to lines
    "repeat_word_ratio": ("n_words", 99, 1.5, 16, 0.5),  # words in repeated windows to words
    "stutter_ratio": ("n_words", 95, 6.0, 3, 0.4),  # words that repeat the word before to words
    "capital_ratio": ("n_letters", 95, 6.0, 20, 0.6),  # capitals to letters
}


def let(value: Column, then) -> Column:
    """then(value), with the value computed once."""
    return F.transform(F.array(value), then)[0]


def _covered(places: Column) -> Column:
    """Words under windows that start at these sorted places."""
    nexts = F.concat(F.slice(places, F.lit(2), F.size(places)), F.array(F.element_at(places, -1) + WINDOW))
    return F.aggregate(F.zip_with(nexts, places, lambda n, p: F.least(n - p, F.lit(WINDOW))), F.lit(0), lambda a, x: a + x)


def _repeated_words(hashes: Column) -> Column:
    """Of the hashes of a text's windows: words in windows that occur twice or more."""
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(sorted_: Column) -> Column:
        same = lambda x, j: F.get(sorted_, j - 1)["h"].eqNullSafe(x["h"]) | F.get(sorted_, j + 1)["h"].eqNullSafe(x["h"])
        return F.array_sort(F.transform(F.filter(sorted_, same), lambda x: x["i"]))

    return let(pairs, lambda s: let(twice(s), _covered))


def counts(docs: DataFrame, *keep: str) -> DataFrame:
    """keep and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_stutters,
    n_letters, n_capitals (long) of docs(text)."""
    text = F.coalesce("text", F.lit(""))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    words = F.filter(F.split(text, SPACE + "+"), lambda w: w != "")

    def per_words(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - (WINDOW - 1))
        hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, F.lit(WINDOW))))
        repeated = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_repeated_words(h)))
        stutters = F.size(F.filter(w, lambda x, i: x.eqNullSafe(F.get(w, i - 1)))).cast("long")
        return F.struct(F.size(w).cast("long").alias("n"), stutters.alias("stutters"), F.when(F.size(w) < WINDOW, 0).otherwise(repeated).cast("long").alias("repeated"))

    def per_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_START))
    return docs.select(
        *keep,
        let(words, per_words).alias("w"),
        let(lines, per_lines).alias("l"),
        (F.char_length(text).cast("long") - count(SPACE)).alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"),
        count(r"\p{L}").alias("n_letters"),
        count(r"\p{Lu}").alias("n_capitals"),
    ).select(
        *keep, F.col("w.n").alias("n_words"), "word_chars", "n_symbols", F.col("l.n").alias("n_lines"), F.col("l.dup").alias("n_dup_lines"),
        F.col("w.repeated").alias("n_repeat_words"), F.col("w.stutters").alias("n_stutters"), "n_letters", "n_capitals",
    )


def ratios(c: DataFrame) -> DataFrame:
    per = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    return c.withColumns(
        {
            "symbol_ratio": per("n_symbols", "n_words"),
            "dup_line_ratio": per("n_dup_lines", "n_lines"),
            "repeat_word_ratio": per("n_repeat_words", "n_words"),
            "stutter_ratio": per("n_stutters", "n_words"),
            "capital_ratio": per("n_capitals", "n_letters"),
        }
    )


def bucket(value: Column) -> Column:
    """Of a value from 0; 0 has its own, the lowest one."""
    return F.when(value > 0, F.ceil(F.log(value) / F.log(F.lit(GROWTH))).cast("int")).otherwise(F.lit(-(2**31)))


def middle(at: Column) -> Column:
    """The value that stands for a bucket."""
    return F.when(at == -(2**31), 0.0).otherwise(F.pow(F.lit(GROWTH), at) * 2 / (GROWTH + 1))


def sketches(rows: DataFrame, measures: list[str]) -> DataFrame:
    """(lang, source, measure, b, c): of each group's values, how many are in a bucket."""
    one = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("b")) for m in measures])).alias("m")
    return rows.select("lang", "source", one).groupBy("lang", "source", "m.measure", "m.b").agg(F.count(F.lit(1)).alias("c"))


def mixed(own: DataFrame) -> DataFrame:
    """own with each group's sketch mixed with its language's, and that with the whole's. c then counts
    in fine units, in whole numbers, so that no order of summing changes it."""
    unit = 1 << 20
    sizes = own.groupBy("lang", "source", "measure").agg(F.sum("c").alias("n"))
    langs = sizes.groupBy(F.col("lang").alias("l"), F.col("measure").alias("m")).agg(F.sum("n").alias("n_lang"))
    whole = own.groupBy(F.col("measure").alias("m"), "b").agg(F.sum("c").alias("c")).join(langs.groupBy("m").agg(F.sum("n_lang").alias("n_all")), "m")
    lent = whole.select("m", "b", F.expr(f"c * {PRIOR * unit} DIV n_all").alias("w")).join(langs.select("m", "l"), "m")
    lang = own.select(F.col("lang").alias("l"), F.col("measure").alias("m"), "b", (F.col("c") * unit).alias("w")).unionByName(lent.select("l", "m", "b", "w"))
    lang = lang.groupBy("l", "m", "b").agg(F.sum("w").alias("w")).join(langs.select(F.col("l").alias("l2"), F.col("m").alias("m2"), "n_lang"), (F.col("m") == F.col("m2")) & F.col("l").eqNullSafe(F.col("l2")))
    lang = lang.select("l", "m", "b", F.expr(f"w * {PRIOR} DIV (n_lang + {PRIOR})").alias("w"))
    lent = sizes.join(lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("measure") == F.col("m"))).select("lang", "source", "measure", "b", "w")
    mine = own.select("lang", "source", "measure", "b", (F.col("c") * unit).alias("w"))
    return mine.unionByName(lent).groupBy("lang", "source", "measure", "b").agg(F.sum("w").alias("c"))


def quantiles(sketch: DataFrame, percents: list[int]) -> DataFrame:
    """(lang, source, measure, q50, ...) of sketches."""
    group = W.partitionBy("lang", "source", "measure")
    ranked = sketch.withColumns({"upto": F.sum("c").over(group.orderBy("b").rowsBetween(W.unboundedPreceding, 0)), "all": F.sum("c").over(group)})
    return ranked.groupBy("lang", "source", "measure").agg(*[middle(F.min(F.when(F.col("upto") * 100 >= F.col("all") * p, F.col("b")))).alias(f"q{p}") for p in percents])


def fences(rows: DataFrame) -> DataFrame:
    """(g_lang, g_source, a fence for each ratio): from rows(lang, source, ratios and counts) that pass
    the base rule."""
    percents = sorted({50, *(p for _, p, *_ in RATIOS.values())})
    measures = [*RATIOS, *sorted({of for of, *_ in RATIOS.values()})]
    q = quantiles(mixed(cut(sketches(rows, measures))), percents)
    flat = q.groupBy("lang", "source").agg(*[F.max(F.when(F.col("measure") == m, F.struct(*[f"q{p}" for p in percents]))).alias(m) for m in measures])

    def fence(r: str) -> Column:
        of, percent, spread, least, ceiling = RATIOS[r]
        high, half = F.col(r)[f"q{percent}"], F.col(r)["q50"]
        room = least / F.greatest(F.col(of)["q50"], F.lit(1.0))
        return F.least(F.greatest(high + spread * (high - half), room), F.lit(ceiling)).alias(f"{r}_fence")

    return flat.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), *[fence(r) for r in RATIOS])


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, the counts, base_failed, fences, failed_rules array, kept) of
    docs(doc_id, text, lang, source)."""
    rows = cut(ratios(counts(docs, "doc_id", "lang", "source")))
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = rows.withColumn("base_failed", base)
    limits = fences(rows.where("NOT base_failed"))
    # a few numbers a group; by a shuffle, all texts of a group would go to one task
    met = rows.join(F.broadcast(limits), rows.lang.eqNullSafe(limits.g_lang) & rows.source.eqNullSafe(limits.g_source), "left")
    out = [F.when(F.col(r) > F.col(f"{r}_fence"), F.lit(r)) for r in RATIOS]
    failed = F.array_compact(F.array(*out))
    return met.withColumn("failed_rules", failed).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("g_lang", "g_source")
