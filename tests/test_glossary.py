"""The glossary as a table, against one pattern a term."""

import random
import re

from tidemark.functions import text as T
from tidemark.operators import glossary


def plain_terms(text, terms):
    n = T._normalize(text) or ""
    return sorted({(fr, en) for fr, en in terms if re.search(r"\b" + r"\s+".join(map(re.escape, T._normalize(fr).split())) + r"[sx]?\b", n)})


TERMS = [("rapport", "report"), ("rapport de vente", "sales report"), ("prévision", "forecast"), ("jeu", "game"), ("jeu d'essai", "trial set"), ("e-mail", "email"), ("bas", "low"), ("vente", "sale")]
TEXTS = ["Les Rapport de ventes, et le rapport.", "PRÉVISIONS\tde ventes", "des jeu d'essais; un jeu", "un e-mail (bas)", "basse rapporte", None, "", "rapport  de   ventes rapport"]


def run(spark, terms, texts):
    t = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return t, spark.createDataFrame(terms, "fr string, en string")


def test_relevant_terms(spark):
    t, g = run(spark, TERMS, TEXTS)
    got = {r.id: [tuple(x) for x in r.terms] for r in glossary.relevant(t, g, ["id"]).collect()}
    assert got == {i: plain_terms(x, TERMS) for i, x in enumerate(TEXTS)} and got[0] == [("rapport", "report"), ("rapport de vente", "sales report"), ("vente", "sale")]
    assert glossary.relevant(t, g.limit(0), ["id"]).where("size(terms) > 0").count() == 0


def test_translation_takes_the_longest_first(spark):
    t, g = run(spark, TERMS, TEXTS)
    got = {r.id: r.translated for r in glossary.translated(t, g, ["id"]).collect()}
    assert got[0] == "les sales report, et le report." and got[2] == "des trial set; un game" and got[4] is None and got[5] is None
    assert got[7] == "sales report report"


def test_missing_terms(spark):
    pairs = [(0, "le rapport de vente", "the sale"), (1, "la prévision", "Forecasting it"), (2, "un jeu", "none"), (3, "un rapport de vente", "Sales   reports and a sale"), (4, None, None), (5, "e-mail", "an Email"), (6, "jeu", "the endgame")]
    p = spark.createDataFrame(pairs, "id int, text_fr string, text_en string")
    got = {r.id: r.missing for r in glossary.missing(p, spark.createDataFrame(TERMS, "fr string, en string"), ["id"]).collect()}
    want = {}
    for i, fr, en in pairs:
        want[i] = sorted({e for _, e in plain_terms(fr, TERMS) if not re.search(r"\b" + r"\s+".join(map(re.escape, e.lower().split())), (en or "").lower())})
    want[4] = []
    assert got == want and got[6] == ["game"] and got[3] == []


def test_ten_thousand_terms_in_one_join(spark):
    rng = random.Random(1)
    words = [f"mot{i}" for i in range(3_000)]
    terms = sorted({" ".join(rng.choices(words, k=rng.choice([1, 2, 3]))) for _ in range(10_500)})[:10_000]
    pairs = [(x, x.upper()) for x in terms]
    texts = [" ".join([*rng.choices(words, k=30), rng.choice(terms) + "s", *rng.choices(words, k=5)]) for _ in range(40)]
    t, g = run(spark, pairs, texts)
    out = glossary.relevant(t, g, ["id"])
    runs = lambda ws: {" ".join(ws[i : i + n]) for n in (1, 2, 3) for i in range(len(ws) - n + 1)}
    for r in out.collect():
        mine = runs(texts[r.id].split())
        want = sorted(x for x in {*mine, *(m[:-1] for m in mine if m[-1] in "sx")} & set(terms))
        assert [x.fr for x in r.terms] == want
    assert "mot17" not in out._jdf.queryExecution().optimizedPlan().toString()[:2_000]
