"""Document fingerprints by a homomorphic multiset hash.

A text is a multiset of paragraphs (its lines, blank ones too). A paragraph hashes to a wide vector,
and a text's fingerprint is the sum of its paragraphs' vectors, lane by lane, modulo 2 ** 32. So the
order of paragraphs doesn't matter, and paragraphs are put in or taken out by adding or subtracting
their vectors, without the rest of the text.

The vector has two parts. DIGEST_LANES lanes are digests of the paragraph: equal sums mean equal
multisets but for chance. LIKENESS_LANES lanes are sums of +1 or -1, one hashed bit for each pair of
neighbouring words (the last word stands alone): the products of two texts' lanes add up to an
unbiased estimate of what pairs they share, so their cosine tells how alike they are (the error is
near 1 / sqrt(LIKENESS_LANES), less for texts that are alike).

Defined results: a null text counts as empty, and an empty text as one blank paragraph; a very long
text is read whole (a lane counts up to 2 ** 30 pairs); equal fingerprints have likeness 1, also
without words, and one without words has 0 with all others; null doc_ids come first; rows with one
doc_id are ordered by a digest, equal rows follow each other; the only row of a table is its own
next one; of an empty table nothing comes out; extra columns are ignored. Everything runs in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Scratch, numbered

DIGEST_LANES, LIKENESS_LANES = 16, 120
MODULUS = 1 << 32
_BITS = 60  # of a pair's digest that go through one long
_HALF = _BITS // 2  # two lanes share a long while they are summed


def _elements(text: Column) -> Column:
    """Arrays, one a paragraph: its digests, then its pairs of words."""

    def one(p: Column) -> Column:
        words = F.filter(F.split(p, SPACE + "+"), lambda w: w != "")
        digests = F.concat(F.sha2(F.concat(F.lit("0:"), p), 256), F.sha2(F.concat(F.lit("1:"), p), 256))
        pairs = F.transform(F.array(words), lambda w: F.transform(w, lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1))))[0]
        return F.concat(F.array(digests), pairs)

    return F.transform(F.split(text, "\n"), one)


def _number(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("long")


def vectors(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, v) for each distinct keys of texts(keys, text): v is an array of DIGEST_LANES +
    LIKENESS_LANES numbers below 2 ** 32. Rows of one key count as parts of one text."""
    parts = texts.select(*keys, F.explode(_elements(F.col(text))).alias("part")).select(*keys, F.posexplode("part").alias("pos", "e"))
    hashed = parts.select(*keys, "pos", "e", F.when(F.col("pos") > 0, F.md5("e")).alias("h"))
    hashed = hashed.select(*keys, "pos", "e", *[_number(F.substring("h", 1 + 15 * i, 15)).alias(f"h{i}") for i in range(LIKENESS_LANES // _BITS)])
    digests = [F.sum(F.when(F.col("pos") == 0, _number(F.substring("e", 1 + 8 * i, 8)))).alias(f"d{i}") for i in range(DIGEST_LANES)]
    both = F.lit(1 | 1 << _HALF)
    counts = [F.coalesce(F.sum(F.shiftright(f"h{i}", s).bitwiseAND(both)), F.lit(0)).alias(f"c{i}_{s}") for i in range(LIKENESS_LANES // _BITS) for s in range(_HALF)]
    sums = hashed.groupBy(*keys).agg(F.count("h0").alias("pairs"), *digests, *counts)
    ones = []
    for i in range(LIKENESS_LANES // _BITS):
        packed = [F.col(f"c{i}_{s}") for s in range(_HALF)]
        ones += [c.bitwiseAND(F.lit((1 << _HALF) - 1)) for c in packed] + [F.shiftright(c, _HALF) for c in packed]
    lanes = [F.col(f"d{i}") for i in range(DIGEST_LANES)] + [2 * c - F.col("pairs") for c in ones]
    return sums.select(*keys, F.transform(F.array(*lanes), lambda x: F.pmod(x, F.lit(MODULUS))).alias("v"))


def plus(a: Column, b: Column) -> Column:
    """The vector of two texts' paragraphs together."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + y, F.lit(MODULUS)))


def minus(a: Column, b: Column) -> Column:
    """The vector of what is left of a's paragraphs when b's are taken out."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x - y, F.lit(MODULUS)))


def as_text(v: Column) -> Column:
    return F.array_join(F.transform(v, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """0 to 1, of two vectors."""
    return _likeness(a == b, _signed(a), _signed(b))


def _signed(v: Column) -> Column:
    """The likeness lanes as signed numbers."""
    return F.transform(F.slice(v, DIGEST_LANES + 1, LIKENESS_LANES), lambda x: F.when(x >= MODULUS // 2, x - MODULUS).otherwise(x).cast("int"))


def _likeness(same: Column, a: Column, b: Column) -> Column:
    double = lambda v: F.transform(v, lambda x: x.cast("double"))
    dot = lambda x, y: F.aggregate(F.zip_with(double(x), double(y), lambda p, q: p * q), F.lit(0.0), lambda s, z: s + z)
    cosine = F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))
    return F.when(same, F.lit(1.0)).otherwise(F.round(F.least(F.greatest(cosine, F.lit(0.0)), F.lit(1.0)), 6))


def packed(v: Column) -> Column:
    """A vector in less room: the digest lanes as bytes, the likeness lanes as signed numbers."""
    return F.struct(F.unhex(as_text(F.slice(v, 1, DIGEST_LANES))).alias("digests"), _signed(v).alias("signs"))


def packed_text(p: Column) -> Column:
    """as_text() of a packed vector."""
    return F.concat(F.lower(F.hex(p["digests"])), as_text(F.transform(p["signs"], lambda x: F.pmod(x.cast("long"), F.lit(MODULUS)))))


def packed_likeness(p: Column, q: Column) -> Column:
    """likeness() of two packed vectors."""
    return _likeness((p["digests"] == q["digests"]) & (p["signs"] == q["signs"]), p["signs"], q["signs"])


def edited(text: Column, beginning: Column) -> Column:
    """The last quarter of a text's characters replaced by as many of another text's first ones."""
    quarter = F.floor(F.char_length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - quarter), F.substring(beginning, F.lit(1), quarter))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row
    of docs(doc_id, text); edited is its text with the next document's beginning, in the order of doc_id.

    Equal rows are one class until the end: all but the last are followed by themselves. Order and
    neighbours are found on narrow rows; texts are shuffled once, and of a text's neighbour only as
    much as replaces a quarter. A class's vectors are made where its texts meet, put in one row and
    written once, packed; what goes to the class before is the likeness lanes."""
    scratch = Scratch(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), text)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), text.alias("text"))
    counted = rows.select("doc_id", "key", F.char_length("text").cast("long").alias("n_chars")).groupBy("doc_id", "key", "n_chars").agg(F.count(F.lit(1)).alias("times"))
    order = scratch.cut(numbered(scratch, counted, [], ["doc_id", "key"]))
    following = order.select(F.col("key").alias("next_key"), F.pmod(F.col("idx") - 1, F.col("n")).alias("before"))
    classes = scratch.cut(order.join(following, F.col("idx") == F.col("before")).select("key", "doc_id", "n_chars", "times", "next_key"))
    texts = rows.select("key", "text").dropDuplicates(["key"])
    asked = classes.select(F.col("next_key").alias("giver"), F.col("key").alias("taker"), F.floor(F.col("n_chars") / 4).cast("int").alias("quarter"))
    given = texts.join(asked, F.col("key") == F.col("giver")).select("taker", F.substring("text", F.lit(1), F.col("quarter")).alias("given"))
    times = classes.select(F.col("key").alias("of"), "times")
    met = texts.join(given, F.col("key") == F.col("taker")).join(times, F.col("key") == F.col("of"))
    # the paragraphs before the edit are hashed once: what both texts share, and the rest of each
    split = F.substring(F.col("text"), F.lit(1), F.char_length("text") - F.floor(F.char_length("text") / 4).cast("int"))
    met = met.withColumn("split", split).withColumn("open", F.substring_index("split", "\n", -1))
    met = met.withColumn("shared", F.char_length("split") - F.char_length("open"))
    rest = lambda t: F.substring(t, F.col("shared") + 1, F.char_length(t))
    whole = F.when(F.col("shared") > 0, F.substring(F.col("text"), F.lit(1), F.col("shared") - 1))
    made = met.select("key", "times", "shared", "text", whole.alias("whole"), edited(F.col("text"), F.col("given")).alias("last"), edited(F.col("text"), F.col("text")).alias("self"))
    side = lambda name, t, of=None: F.struct(F.lit(name).alias("side"), t.alias("text"), F.unhex(F.lit("") if of is None else F.sha2(of, 256)).alias("sha"))
    sides = [
        F.when(F.col("whole").isNotNull(), side("both", F.col("whole"))), side("text", rest(F.col("text"))), side("last", rest(F.col("last")), F.col("last")),
        F.when(F.col("times") > 1, side("self", rest(F.col("self")), F.col("self"))),
    ]
    sides = made.select("key", F.explode(F.array_compact(F.array(*sides))).alias("s")).select("key", "s.*")
    # all sides of a class are where its texts met: no shuffle
    of = lambda name: F.col("side") == name
    picked = [F.max(F.when(of(x), F.col("v"))).alias(x) for x in ("both", "text", "last", "self")]
    found = vectors(sides, ["key", "side", "sha"]).groupBy("key").agg(*picked, *[F.max(F.when(of(x), F.col("sha"))).alias(f"sha_{x}") for x in ("last", "self")])
    full = lambda x: F.when(F.col("both").isNull(), F.col(x)).otherwise(plus(F.col(x), F.col("both")))
    found = found.select("key", "sha_last", "sha_self", *[F.when(F.col(x).isNotNull(), packed(full(x))).alias(x) for x in ("text", "last", "self")])
    found = scratch.cut(classes.join(found, "key"), compression="zstd")
    theirs = found.select(F.col("key").alias("next_of"), F.col("text").alias("theirs"))
    out = found.join(theirs, F.col("next_key") == F.col("next_of"))
    nears = [packed_likeness(F.col("text"), F.col(x)).alias(f"near_{x}") for x in ("theirs", "last", "self")]
    out = out.select("*", *nears).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    either = lambda last, own: F.when(F.col("copy") == 1, last).otherwise(own)
    return out.select(
        "doc_id", "n_chars", F.lower(F.hex(either(F.col("sha_last"), F.col("sha_self")))).alias("edited_sha256"), packed_text(F.col("text")).alias("fingerprint"),
        packed_text(either(F.col("last"), F.col("self"))).alias("edited_fingerprint"), either(F.col("near_last"), F.col("near_self")).alias("near_edited"),
        either(F.col("near_theirs"), F.lit(1.0)).alias("near_next"),
    )


_SQL_DIGESTS = ", ".join(f"sum(('0x' || substr(h, {1 + 8 * i}, 8))::BIGINT)::BIGINT" for i in range(DIGEST_LANES))
_SQL_SIGNS = ", ".join(f"sum(2 * ((h{i} >> {s}) & 1) - 1)::BIGINT" for i in range(LIKENESS_LANES // _BITS) for s in range(_BITS))
#: fingerprints() in DuckDB's SQL.
SQL = f"""
WITH rows AS (SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(text, '')) AS key FROM documents),
ordered AS (
  SELECT *, row_number() OVER o AS no, length(text) AS n_chars, coalesce(lead(text) OVER o, first_value(text) OVER o) AS next_text,
         coalesce(lead(key) OVER o, first_value(key) OVER o) AS next_key FROM rows WINDOW o AS (ORDER BY doc_id NULLS FIRST, key)),
changed AS (SELECT *, substr(text, 1, n_chars - n_chars // 4) || substr(next_text, 1, n_chars // 4) AS edited FROM ordered),
sides AS (SELECT DISTINCT text AS t FROM changed UNION SELECT DISTINCT edited FROM changed),
paragraphs AS (SELECT t, unnest(string_split(t, chr(10))) AS p FROM sides),
hashed AS (SELECT t, sha256('0:' || p) || sha256('1:' || p) AS h FROM paragraphs),
digests AS (SELECT t, [{_SQL_DIGESTS}] AS x FROM hashed GROUP BY t),
worded AS (SELECT t, list_filter(string_split_regex(p, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM paragraphs),
pairs AS (SELECT t, unnest(list_transform(w, lambda x, i: md5(concat_ws(' ', x, w[i + 1])))) AS h FROM worded),
halves AS (SELECT t, ('0x' || substr(h, 1, 15))::BIGINT AS h0, ('0x' || substr(h, 16, 15))::BIGINT AS h1 FROM pairs),
signs AS (SELECT t, [{_SQL_SIGNS}] AS x FROM halves GROUP BY t),
lanes AS (
  SELECT t, list_transform(d.x || coalesce(s.x, list_transform(range({LIKENESS_LANES}), lambda i: 0::BIGINT)), lambda x: ((x % {MODULUS}) + {MODULUS}) % {MODULUS}) AS x
  FROM digests d LEFT JOIN signs s USING (t)),
prints AS (
  SELECT t, array_to_string(list_transform(x, lambda y: printf('%08x', y)), '') AS print,
         list_transform(x[{DIGEST_LANES + 1}:], lambda y: (CASE WHEN y >= {MODULUS // 2} THEN y - {MODULUS} ELSE y END)::DOUBLE) AS v FROM lanes),
met AS (
  SELECT c.*, a.print AS fingerprint, b.print AS edited_fingerprint, n.print AS next_print, a.v AS av, b.v AS bv, n.v AS nv
  FROM changed c JOIN prints a ON a.t = c.text JOIN prints b ON b.t = c.edited JOIN prints n ON n.t = c.next_text),
dots AS (SELECT *, list_dot_product(av, av) AS aa, list_dot_product(bv, bv) AS bb, list_dot_product(nv, nv) AS nn, list_dot_product(av, bv) AS ab, list_dot_product(av, nv) AS an FROM met)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint,
  CASE WHEN fingerprint = edited_fingerprint THEN 1.0 WHEN aa * bb = 0 THEN 0.0 ELSE round(least(greatest(ab / (sqrt(aa) * sqrt(bb)), 0), 1), 6) END::DOUBLE AS near_edited,
  CASE WHEN fingerprint = next_print THEN 1.0 WHEN aa * nn = 0 THEN 0.0 ELSE round(least(greatest(an / (sqrt(aa) * sqrt(nn)), 0), 1), 6) END::DOUBLE AS near_next
FROM dots
"""
