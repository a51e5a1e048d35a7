"""Manifest, collocations and fingerprints against brute force and defined edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.llm import collocations, fingerprints, manifest, queries

SF = "/root/testdata/sf0.001"


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# manifest


def field(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, i):
    for level in levels[:-1]:
        at = i // 16 * 16
        yield level[at:i], level[i + 1 : at + 16]
        i //= 16


def plain_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    leaf = lambda r: sha(*map(field, r))
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: tree([leaf(r) for r in by[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            path = [*siblings(trees[s], i), *siblings(top, k)]
            h = leaf(r)
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                h = leaf((*r[:4], re.sub("[A-Z]", lambda m: m[0].lower(), r[4])))
            for a, b in path:
                h = sha(*a, h, *b)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], sha(*[x for a, b in path for x in a + b]), h, h == top[-1][0]))
    return sorted(out, key=str)


def verified(docs, **how):
    return sorted([tuple(r) for r in manifest.verify(docs, **how).collect()], key=str)


def test_manifest(docs, nothing):
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert verified(docs.repartition(5)) == plain_manifest(rows)
    assert verified(nothing) == []
    alone = docs.where("doc_id = 107")
    assert verified(alone) == plain_manifest([r for r in rows if r[0] == 107]) and verified(alone)[0][6] is True


@pytest.mark.parametrize("span", [1, 2, 3])
def test_manifest_of_trees_of_several_levels(spark, span):
    """Sources of 1, 16, 17 and 600 rows, and more than 16 sources."""
    sizes = {None: 3, "big": 600, "a": 1, "b": 16, "c": 17, "ä": 2} | {f"s{i}": 1 + i % 3 for i in range(20)}
    rows = [(d, s, "en", i, f"Text {i} of {s}") for d, (s, i) in enumerate((s, i) for s, n in sizes.items() for i in range(n))]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert verified(df, span=span) == plain_manifest(rows)


def test_a_proof_shows_any_change(spark):
    rows = [(i, "s", "en", 4, f"text {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    changed = F.when(F.col("doc_id") == 7, manifest.leaf(lang=F.lit("de"))).when(F.col("doc_id") == 8, manifest.leaf(text=F.lit(None).cast("string"))).otherwise(manifest.leaf())
    out = manifest.manifest(df, also=changed).select("doc_id", (manifest.fold(F.col("also"), F.col("path")) == F.col("root")).alias("ok"))
    assert {r.doc_id for r in out.collect() if not r.ok} == {7, 8}


# collocations


def plain_collocations(rows, least, top):
    counts, n = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f = counts.setdefault(lang, Counter())
            for k in range(1, 6):
                f.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        good = {p: a for p, a in f.items() if a >= least}
        held = {p[i : i + m] for p, a in good.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if good[p[i : i + m]] == a}
        found = []
        for p, a in good.items():
            if len(p) > 1 and p not in held:
                score, k = min((1000 * a * n[lang] // (good[p[:k]] * good[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), a, good[p[:k]], good[p[k:]], n[lang], score))
        out += [(lang, i, p.decode(), *rest) for i, (_, _, p, *rest) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def phrases(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)] + ["Über", "日本", "O'Neil", "a-b"]
    fixed = ["New York City hall today", "in spite of", "été chaud", "x x x x x x x"]
    rows = []
    for i in range(300):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else " ".join(rng.choices(words, k=rng.randrange(1, 5))) for _ in range(12)]
        rows.append((rng.choice(["en", "en", None, "fr", "und"]), rng.choice(["", " ", "\t "]) + "".join(p + rng.choice([" ", "  ", ". ", ",", "\n", "\t", "!?"]) for p in parts)))
    rows += [("en", None), ("en", ""), (None, " ,.\n"), ("xx", "word"), ("en", "long " * 30_000)]
    return rows


@pytest.mark.parametrize("words_a_counter", [1, 1 << 20])
def test_collocations(spark, phrases, monkeypatch, words_a_counter):
    """With counters to spare, and with so few that they rule out nothing; in small pieces."""
    monkeypatch.setattr(collocations, "LEAST_BITS", 1)
    df = spark.createDataFrame(phrases, "lang string, text string").repartition(3)
    got = sorted(tuple(r) for r in collocations.collocations(df, least=20, top=50, words_a_counter=words_a_counter).collect())
    assert got == plain_collocations(phrases, 20, 50) and len(got) > 20


def test_collocations_of_nothing(docs, nothing):
    assert collocations.collocations(nothing).count() == 0
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    got = sorted(tuple(r) for r in collocations.collocations(docs).collect())
    assert got == plain_collocations(rows, 100, 2_000) and len(got) >= 4


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 200, (5_000, 3)).astype(np.int32), axis=0)
    slots = collocations.Slots(keys)
    assert sorted(slots.find(list(keys.T))) == list(range(len(keys)))
    others = rng.integers(200, 400, (1_000, 3)).astype(np.int32)
    assert (slots.find(list(others.T)) == -1).all()
    assert (collocations.Slots(keys[:0]).find(list(keys.T)) == -1).all()


def test_phrases_of_one_hash_stay_apart(monkeypatch):
    phrases = np.random.default_rng(3).integers(0, 9, (500, 2)).astype(np.int32)
    want = Counter(map(tuple, phrases.tolist()))
    for bits in (64, 2):
        plain = collocations.phrase_hash
        monkeypatch.setattr(collocations, "phrase_hash", lambda p, s, bits=bits, plain=plain: plain(p, s) >> np.uint64(64 - bits))
        merged, counts = collocations._merged(phrases, np.ones(500, np.int64))
        assert {tuple(p): n for p, n in zip(merged.tolist(), counts.tolist(), strict=True)} == want
        monkeypatch.undo()


def test_streams_lose_no_words():
    ids = np.random.default_rng(2).integers(-1, 50, 30_000).astype(np.int32)
    ids[5_000:25_000] = 7  # a piece longer than rows
    rows = collocations._row_ids(ids)
    assert np.array_equal(np.concatenate([np.frombuffer(x.as_buffer(), np.int32) for x in rows]), np.append(ids, -1))
    assert len(rows) > 2 and all(np.frombuffer(x.as_buffer(), np.int32)[-1] == -1 for x in rows)


# fingerprints


def plain_vector(text: str) -> list[int]:
    v = [0] * 136
    for p in text.split("\n"):
        digests = sha("0:", p) + sha("1:", p)
        for i in range(16):
            v[i] += int(digests[8 * i : 8 * i + 8], 16)
        words = re.findall(r"[^\x20\x09-\x0D]+", p)
        for i, w in enumerate(words):
            h = hashlib.md5(" ".join(words[i : i + 2]).encode()).hexdigest()
            for half in range(2):
                bits = int(h[15 * half : 15 * half + 15], 16)
                for b in range(60):
                    v[16 + 60 * half + b] += 2 * (bits >> b & 1) - 1
    return [x % 2**32 for x in v]


def plain_likeness(a, b) -> float:
    if a == b:
        return 1.0
    signed = lambda v: np.array([x - 2**32 if x >= 2**31 else x for x in v[16:]], float)
    a, b = signed(a), signed(b)
    return round(min(max(float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)), 0.0), 1.0), 6) if a.any() and b.any() else 0.0


def plain_fingerprints(rows):
    key = lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{'-' if r[0] is None else r[0]}:{r[1] or ''}".encode()).hexdigest())
    rows, out = sorted(rows, key=key), []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        q = len(text) // 4
        changed = text[: len(text) - q] + after[:q]
        a, b, c = map(plain_vector, (text, changed, after))
        hexed = lambda v: "".join(f"{x:08x}" for x in v)
        out.append((doc_id, len(text), sha(changed), hexed(a), hexed(b), plain_likeness(a, b), plain_likeness(a, c)))
    return sorted(out, key=str)


def test_fingerprints_are_shuffled_once_and_packed(spark, docs):
    out = fingerprints.fingerprints(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hash") + plan.count("BroadcastExchange") <= 2, plan  # a class's one row, and what its neighbour needs of it
    v = fingerprints.vectors(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).distinct(), ["doc_id"])
    v = v.select(F.col("v").alias("a"), fingerprints.minus(F.lag("v", 1).over(Window.orderBy("doc_id")), F.col("v")).alias("b")).where("b IS NOT NULL")
    p = v.select("a", "b", fingerprints.packed(F.col("a")).alias("p"), fingerprints.packed(F.col("b")).alias("q"))
    rows = p.select(fingerprints.as_text(F.col("b")), fingerprints.packed_text(F.col("q")), fingerprints.likeness(F.col("a"), F.col("b")), fingerprints.packed_likeness(F.col("p"), F.col("q"))).collect()
    assert rows and all(r[0] == r[1] and r[2] == r[3] for r in rows)


def test_fingerprints(spark, docs, nothing):
    more = [(7, "A\nB\n\nC d e f"), (7, "B\nA\nC d e f\n"), (8, "\n"), (9, "one"), (9, "one"), (9, "one"), (10, "日本 \U0001f600 text\nof lines\nand more of it here")]
    df = docs.select("doc_id", "text", F.col("key").alias("v")).unionByName(spark.createDataFrame([(*r, "x") for r in more], "doc_id long, text string, v string"))
    got = sorted([tuple(r) for r in fingerprints.fingerprints(df.repartition(4)).collect()], key=str)
    want = plain_fingerprints([tuple(r) for r in df.select("doc_id", "text").collect()])
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], atol=2e-6)
    assert fingerprints.fingerprints(nothing).count() == 0
    assert [r.near_next for r in fingerprints.fingerprints(docs.where("doc_id = 3")).collect()] == [1.0]


def test_paragraphs_go_in_and_out(spark):
    texts = {"all": "a b c\nd e\na b c\n", "some": "d e\n", "rest": "a b c\na b c", "moved": "\nd e\na b c\na b c"}
    v = {r.k: r.v for r in fingerprints.vectors(spark.createDataFrame(list(texts.items()), "k string, text string"), ["k"]).collect()}
    assert v["all"] == v["moved"] != v["some"]
    row = spark.createDataFrame([(v["all"], v["some"], v["rest"])], "a array<long>, s array<long>, r array<long>")
    out = row.select(fingerprints.plus(F.col("s"), F.col("r")).alias("put"), fingerprints.minus(F.col("a"), F.col("s")).alias("took")).first()
    assert out.put == v["all"] and out.took == v["rest"]


@pytest.mark.parametrize("name", ["op11_manifest", "op12_collocations", "op13_fingerprints"])
def test_queries_equal_their_sql(spark, name):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = c.execute(queries.oracle_sql()[name])
    columns = sorted(x[0] for x in want.description)
    place = [[x[0] for x in want.description].index(k) for k in columns]
    rows = sorted(str([r[i] for i in place]) for r in want.fetchall())
    assert sorted(str([r[k] for k in columns]) for r in queries.queries()[name](spark, SF).collect()) == rows
