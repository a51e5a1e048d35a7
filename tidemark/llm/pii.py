"""Personal data: base patterns, and candidates that boosted trees accept or reject.

The base patterns (email, ip, card, phone) always hold. Beside them, generators of high recall
propose spans that may overlap: phones without a plus, spelled-out emails, social security
numbers, bank accounts, secrets. Boosted trees score each candidate by its format and by the
words around it; a calibrated threshold for its kind decides. Trees and thresholds are fitted on
the driver, in numpy, on a seeded set of written-out examples (`training_set`); scoring runs in
the JVM only, as expressions over arrays of candidates, so there is no shuffle.

Patterns are written so that each text is scanned in linear time: a run is entered at its start
only, and repeats are possessive. Offsets count code points and end exclusively.

Defined results: a null or empty text has no spans; ties and repeated rows give equal results;
an empty table gives no rows; a very long text is searched whole; extra columns are ignored by
report and handed on by redact, whatever they are called.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import boosting
from .rules import let

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "secret", "ssn")
_PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
#: kind: (what a text must contain to be scanned, pattern). Each finds what its plain form finds,
#: leftmost first and without overlaps.
BASE = {
    "email": ("@", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (None, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (None, r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": ("+", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: kind: pattern of the candidates.
GENERATORS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[({]?\x20?(?i:at)\x20?[\])}]?\x20?[A-Za-z0-9-]{2,63}+\x20?[\[({]?\x20?(?i:dot)\x20?[\])}]?\x20?[A-Za-z]{2,10}(?![A-Za-z0-9])",
    "phone": r"(?<![A-Za-z0-9+.-])(?:\(?[0-9]{2,4}+(?:\)?[\x20./-]{1,2}+|\))[0-9]{2,4}+[\x20./-]?[0-9]{2,5}+(?:[\x20./-][0-9]{2,4}+)?+|[0-9]{9,12}+)(?![0-9A-Za-z])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{16,}+",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}[\x20-][0-9]{2}[\x20-][0-9]{4}(?![0-9A-Za-z-])",
}
#: Characters of context on the left.
CONTEXT = 28
#: feature: (pattern, of "m": matches in the candidate, of "l": found in the left context or not).
_COUNTS = {
    "digits": (r"[0-9]", "m"), "upper": (r"[A-Z]", "m"), "lower": (r"[a-z]", "m"), "hex": (r"[0-9a-fA-F]", "m"),
    "blanks": (r"\x20", "m"), "marks": (r"[./_+=()\[\]{}-]", "m"), "turns": (r"[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])", "m"),
    "parts": (r"[^A-Za-z0-9]+", "m"), "cased_turns": (r"[a-z](?=[A-Z])", "m"), "brackets": (r"[\[({]", "m"),
    "vowels": (r"[aeiouAEIOU]", "m"), "clusters": (r"[b-df-hj-np-tv-xzB-DF-HJ-NP-TV-XZ]{4,}+", "m"),
}
_CUES = {
    "cue_secret": r"(?i)token|secret|passw|pwd|api.?key|access.?key|bearer|auth|credential",
    "cue_phone": r"(?i)phone|\btel\b|\btel[.:]|call|mobile|cell|fax|tél|handy|teléfono|whatsapp",
    "cue_id": r"(?i)\bssn\b|social|tax.?id|insurance|passport",
    "cue_bank": r"(?i)iban|bank|account|konto|compte|cuenta",
    "cue_mail": r"(?i)mail|contact|write|courriel|correo",
    "cue_code": r"(?i)version|order|invoice|isbn|issn|article|page|part|model|commit|sha|md5|checksum|https?:|www\.|doi",
    "assigned": r"[=:]\s*[\"'`]?$",
    "quoted": r"[\"'`]$",
}
FEATURES = ["length", *_COUNTS, *_CUES, *(f"is_{k}" for k in GENERATORS)]


@dataclass(frozen=True)
class Model:
    trees: boosting.Trees
    thresholds: dict[str, float]  # of the log-odds, by kind


def _features(kind: str, match: str, left: str) -> list[float]:
    """As the columns have it, for training."""
    out = [float(len(match))]
    out += [float(len(re.findall(p, match))) for p, _ in _COUNTS.values()]
    out += [float(bool(re.search(p, left))) for p in _CUES.values()]
    return out + [float(kind == k) for k in GENERATORS]


def training_set(seed: int = 4, n: int = 9000) -> tuple[list[tuple[str, str, str]], np.ndarray]:
    """(kind, candidate, left context) and 1 or 0: candidates as the generators propose them,
    written from the formats that personal data and its look-alikes have."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    chars = lambda alphabet, k: "".join(pick(alphabet) for _ in range(k))
    digits, hexes, letters, upper = "0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    b64 = letters + upper + digits
    word = lambda: "".join(pick(["an", "er", "the", "on", "is", "re", "ti", "le", "ou", "ent", "lo", "ra"]) for _ in range(int(rng.integers(1, 4))))
    prose = lambda: " ".join(word() for _ in range(5))[-CONTEXT:] + " "

    def phone():
        return pick([
            lambda: f"({chars(digits, 3)}) {chars(digits, 3)}-{chars(digits, 4)}", lambda: f"{chars(digits, 3)}-{chars(digits, 3)}-{chars(digits, 4)}",
            lambda: f"{chars(digits, 3)}.{chars(digits, 3)}.{chars(digits, 4)}", lambda: f"0{chars(digits, 2)} {chars(digits, 3)} {chars(digits, 4)}",
            lambda: f"0{chars(digits, 3)}/{chars(digits, 4)}{chars(digits, 2)}", closed, bare,
        ])()

    def closed():
        return f"({chars(digits, 3)}){chars(digits, 3)}-{chars(digits, 4)}"

    def bare():
        return pick(["0", pick(digits[1:])]) + chars(digits, int(rng.integers(8, 12)))

    def name():  # of something in code: words joined by case or marks
        parts = [word() for _ in range(int(rng.integers(4, 8)))]
        return pick([lambda: parts[0] + "".join(x.title() for x in parts[1:]), lambda: "_".join(parts), lambda: "".join(x.title() for x in parts), lambda: "".join(parts)])().ljust(16, "a")

    def secret():
        return pick([lambda: chars(hexes, int(pick([32, 40, 64]))), lambda: chars(hexes, 40).upper(), lambda: chars(b64, int(rng.integers(20, 60))), lambda: "sk_live_" + chars(b64, 24), lambda: "AKIA" + chars(upper + digits, 16), lambda: "ghp_" + chars(b64, 36), lambda: chars(letters + upper, int(rng.integers(20, 48))), lambda: chars(letters, int(rng.integers(20, 40)))])()

    def positive():
        kind = pick(["email", "phone", "iban", "secret", "secret", "ssn"])
        if kind == "email":
            a, b = pick([(" at ", " dot "), ("(at)", "(dot)"), (" [at] ", " [dot] "), (" AT ", " DOT "), (" {at} ", " {dot} ")])
            cue = pick(["write to ", "e-mail: ", "contact ", "mail "]) if a in (" at ", " AT ") or rng.random() < 0.5 else ""
            return kind, f"{word()}.{word()}{a}{word()}{b}{pick(['com', 'org', 'net', 'de'])}", prose() + cue
        if kind == "phone":
            p = phone()
            return kind, p, prose() + (pick(["phone ", "tel. ", "Tel: ", "call ", "mobile: ", "fax ", "tel "]) if p[:1] != "(" or ")" in p and " " not in p or rng.random() < 0.5 else "")
        if kind == "iban":
            body = chars(digits, int(rng.integers(14, 24)))
            body = " ".join([body[i : i + 4] for i in range(0, len(body), 4)]) if rng.random() < 0.4 else body
            return kind, f"{pick(['DE', 'FR', 'ES', 'GB', 'IT'])}{chars(digits, 2)}{' ' if ' ' in body else ''}{body}", prose() + pick(["", "IBAN ", "account: ", "Konto "])
        if kind == "secret":
            return kind, secret(), prose() + pick(["token = \"", "TOKEN = \"", "api_key: ", "secret='", "password: ", "Bearer ", "auth_token=", "access key: \""])
        return kind, f"{chars('12345678', 1)}{chars(digits, 2)}-{chars(digits, 2)}-{chars(digits, 4)}", prose() + pick(["", "SSN ", "ssn: ", "social security "])

    def negative():
        kind = pick(["email", "phone", "phone", "iban", "secret", "secret", "ssn"])
        if kind == "email":  # "look at page dot com" is prose
            return kind, f"{word()} at {word()} dot {word()[:6]}", prose()
        if kind == "phone":
            return kind, pick([lambda: f"{chars('12', 1)}{chars(digits, 3)}-{chars(digits, 2)}-{chars(digits, 2)}", lambda: f"{chars(digits, 2)}.{chars(digits, 2)}.{chars(digits, 4)}", lambda: f"{chars(digits, 3)} {chars(digits, 3)} {chars(digits, 3)}", lambda: f"{chars(digits, 4)} {chars(digits, 4)}", phone, bare, closed])(), prose() + pick(["", "on ", "order ", "version ", "ISBN ", "invoice ", "part "] if rng.random() < 0.7 else ["order ", "invoice ", "part ", "model "])
        if kind == "iban":
            return kind, f"{chars(upper, 2)}{chars(digits, 2)}{chars(upper, int(rng.integers(8, 16)))}", prose() + pick(["", "model ", "part "])
        if kind == "secret" and rng.random() < 0.3:  # a name in code, where a secret might be
            return kind, name(), prose() + pick(["token = ", "secret: ", "password = ", "auth ", "api_key = "])
        if kind == "secret":
            joined = lambda sep, k=6: sep.join(word() for _ in range(k)).ljust(16, "a")
            match = pick([
                lambda: joined("", 8)[:40], lambda: joined("-"), lambda: joined("_"), lambda: joined("/"), lambda: joined("", 8).upper(),
                lambda: pick("-=_") * int(rng.integers(16, 60)), lambda: chars(digits, int(rng.integers(20, 40))), lambda: chars(hexes, 40), name,
            ])()
            return kind, match, prose() + pick(["", "commit ", "sha ", "https://", "md5 ", "see "])
        return kind, f"{chars(digits, 3)} {chars(digits, 2)} {chars(digits, 4)}", prose() + pick(["", "part ", "order ", "page "])

    rows, y = [], []
    for i in range(n):
        label = int(rng.random() < 0.4)
        kind, match, left = positive() if label else negative()
        rows.append((kind, match, left[-CONTEXT:]))
        y.append(label)
    return rows, np.array(y, dtype=float)


@lru_cache(1)
def model(precision: float = 0.98) -> Model:
    """Trees from two thirds of the examples; thresholds from the rest: for each kind the least
    score from which on so many of the accepted are personal data."""
    rows, y = training_set()
    x = np.array([_features(*r) for r in rows])
    cut_at = len(y) * 2 // 3
    trees = boosting.fit(x[:cut_at], y[:cut_at], FEATURES)
    score, thresholds = trees.score(x[cut_at:]), {}
    for kind in GENERATORS:
        own = np.array([r[0] == kind for r in rows[cut_at:]])
        order = np.argsort(-score[own])
        s, right = score[own][order], np.cumsum(y[cut_at:][own][order])
        good = np.flatnonzero(right / np.arange(1, len(s) + 1) >= precision)
        thresholds[kind] = max(0.0, float(s[good[-1]]) - 1e-9) if len(good) else float("inf")
    return Model(trees, thresholds)


def _prefix(a: Column, width: int = 256) -> Column:
    """Sums of all elements up to each, itself included; in blocks, so long arrays take n * width steps."""

    def sums(x: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("n"), F.array().cast("array<long>").alias("all"))
        return F.aggregate(x, zero, lambda s, v: F.struct((s["n"] + v).alias("n"), F.concat(s["all"], F.array(s["n"] + v)).alias("all")))["all"]

    def blocks(x: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / width).cast("int"))
        return F.transform(numbers, lambda i: sums(F.slice(x, i * width + 1, F.lit(width))))

    def joined(b: Column) -> Column:
        ends = sums(F.transform(b, lambda x: F.coalesce(F.try_element_at(x, F.lit(-1)), F.lit(0).cast("long"))))
        return let(ends, lambda e: F.flatten(F.transform(b, lambda x, i: F.transform(x, lambda v: v + F.coalesce(F.get(e, i - 1), F.lit(0).cast("long"))))))

    return let(blocks(a), joined)


_SPAN = "array<struct<kind:string,start:long,end:long,match:string>>"


def _found(text: Column, kind: str, pattern: str, when: Column, keep) -> Column:
    """Spans of a pattern's matches that keep(match) holds for: the pieces between matches and the
    matches give their places."""

    def spans(matches: Column) -> Column:
        pieces = F.transform(F.slice(F.split(text, pattern), F.lit(1), F.size(matches)), F.char_length)
        steps = F.zip_with(pieces, matches, lambda p, m: p.cast("long") + F.char_length(m))
        ends = let(steps, lambda a: _prefix(a))
        all_ = F.zip_with(ends, matches, lambda e, m: F.struct(F.lit(kind).alias("kind"), (e - F.char_length(m)).alias("start"), e.alias("end"), m.alias("match")))
        return F.when(F.size(matches) == 0, F.array().cast(_SPAN)).otherwise(F.filter(all_, lambda s: keep(s["match"])))

    return F.when(when, let(F.regexp_extract_all(text, F.lit(pattern), 0), spans)).otherwise(F.array().cast(_SPAN))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _base_keep(kind: str):
    if kind == "ip":
        return lambda m: m.rlike(rf"^(?:{_PART}\.){{3}}{_PART}$")
    if kind == "card":
        return lambda m: F.when(F.length(_digits(m)).between(13, 19), F.call_function("luhn_check", _digits(m))).otherwise(False)
    if kind == "phone":
        return lambda m: F.length(_digits(m)).between(9, 15)
    return lambda m: F.lit(True)


def with_spans(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """keep, base and added: arrays of (kind, start, end, match) of each row of docs, sorted by
    kind as in KINDS, then start."""
    m = model()
    t = F.coalesce(F.col(text), F.lit(""))
    digit = t.rlike("[0-9]")
    base = []
    for kind, (needs, pattern) in BASE.items():
        base.append(_found(t, kind, pattern, F.contains(t, F.lit(needs)) if needs else digit, _base_keep(kind)))
    proposed = []
    for kind, pattern in GENERATORS.items():
        when = {"email": t.rlike(r"(?i)\bat\b.{1,80}\bdot\b|[\[({]at[\])}]"), "secret": F.lit(True)}.get(kind, digit)
        proposed.append(_found(t, kind, pattern, when, lambda _: F.lit(True)))

    def accepted(c: Column) -> Column:
        left = F.substring(t, F.greatest(c["start"] - (CONTEXT - 1), F.lit(1)).cast("int"), F.least(c["start"], F.lit(CONTEXT)).cast("int"))

        def by_features(f: Column) -> Column:
            return m.trees.column(lambda name: f[name])

        row = F.struct(
            F.char_length(c["match"]).cast("double").alias("length"),
            *[F.regexp_count(c["match"], F.lit(p)).cast("double").alias(n) for n, (p, _) in _COUNTS.items()],
            *[left.rlike(p).cast("double").alias(n) for n, p in _CUES.items()],
            *[(c["kind"] == k).cast("double").alias(f"is_{k}") for k in GENERATORS],
        )
        least = F.element_at(F.create_map(*[F.lit(v) for kv in m.thresholds.items() for v in kv]), c["kind"])
        return let(row, by_features) >= least

    found = docs.select(*keep, t.alias("_t"), F.flatten(F.array(*base)).alias("base"), F.flatten(F.array(*proposed)).alias("proposed"))
    t = F.col("_t")
    clear = lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    added = F.when(F.size("proposed") == 0, F.col("proposed")).otherwise(F.filter("proposed", lambda c: clear(c) & accepted(c)))
    return found.select(*keep, "base", added.alias("added"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added and the counts of the
    other kinds) of docs(doc_id, text); the first counts and the digest are of the base spans, spans
    are all of them, n_added counts those that the trees added, of whatever kind."""
    found = with_spans(docs, "doc_id")
    count = lambda kind, of="base": F.size(F.filter(of, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    more = [count(k, "added") for k in KINDS if k not in BASE_KINDS]
    order = F.array(*[F.lit(k) for k in KINDS])
    ranked = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(F.array_position(order, s["kind"]).alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return found.select("doc_id", *[count(k) for k in BASE_KINDS], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(ranked).alias("spans"), F.size("added").cast("long").alias("n_added"), *more)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with every span of the text replaced by its kind in brackets, as [EMAIL]; where spans
    overlap, they go as one, by the kind of the first. A null text stays null."""
    cols = docs.columns
    found = with_spans(docs.select(F.struct(*[docs[c] for c in cols]).alias("row"), docs[text].alias("text")), "row")
    body_of = F.col("row").getField(text)
    spans = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        body = F.substring(body_of, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int"))
        more = F.concat(s["out"], F.array(F.concat(body, F.lit("["), F.upper(x["kind"]), F.lit("]"))))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(x["start"] >= s["at"], more).otherwise(s["out"]).alias("out"))

    def finish(s: Column) -> Column:
        return F.concat(F.array_join(s["out"], ""), F.substring(body_of, (s["at"] + 1).cast("int"), F.lit(2**31 - 1)))

    new = F.when(F.size("base") + F.size("added") == 0, body_of).otherwise(F.aggregate(spans, zero, step, finish))
    return found.select(*[new.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in cols])
