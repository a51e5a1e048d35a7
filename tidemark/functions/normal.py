"""Text in its plain form, in the JVM: lower case, compatibility decomposition, no marks, single spaces.

Python's tables say what each character becomes. Texts of ASCII and texts of Latin letters, nearly all
of them, take a shorter way each. Others are translated character by character, by a table of those
that become one other character or none. What becomes several characters is looked up in one array of
pages of 256 characters and replaced in the whole text; where a text has many such (Korean), each of its
characters looks itself up. All ways agree.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Latin letters with marks, and the letters that are left of them.
MARKED = "".join(chr(c) for c in range(0xC0, 0x180) if len(d := unicodedata.normalize("NFKD", chr(c).lower())) > 1 and d[0].isascii() and all(map(unicodedata.combining, d[1:])))
PLAIN = "".join(unicodedata.normalize("NFKD", c.lower())[0] for c in MARKED)
_PAGE = 256
# A capital sigma after a letter and before none is a final one. Letters with case, and what lies between.
_CASED, _BETWEEN = r"[\p{IsUppercase}\p{IsLowercase}\p{IsTitlecase}]", r"[\p{Mn}\p{Me}\p{Cf}\p{Lm}\p{Sk}'.:·‘’․‧]"
_FINAL = rf"(?<={_CASED}{_BETWEEN}{{0,20}})Σ(?!{_BETWEEN}*{_CASED})"


def plain_character(c: str) -> str:
    """What is left of one character; white space becomes a space."""
    return "".join(" " if x.isspace() else x for x in unicodedata.normalize("NFKD", c.lower()) if not unicodedata.combining(x))


@lru_cache(1)
def _kinds() -> tuple[str, str, str]:
    """Characters that become one other or none, with what the former become; and those that become several,
    but for Korean syllables."""
    plain = {c: plain_character(c) for c in map(chr, range(sys.maxunicode + 1)) if not "\ud800" <= c <= "\udfff" and not "가" <= c <= "힣"}
    one, none = [c for c, p in plain.items() if len(p) == 1 and p != c], [c for c, p in plain.items() if not p]
    return "".join(one + none), "".join(plain[c] for c in one), "".join(c for c, p in plain.items() if len(p) > 1)


@lru_cache(1)
def _pages() -> list[tuple[int, list[str | None]]]:
    """The pages with characters that change."""
    out = []
    for page in range(sys.maxunicode // _PAGE + 1):
        chars = [chr(page * _PAGE + i) for i in range(_PAGE)]
        row = [None if 0xD800 <= ord(c) <= 0xDFFF or (p := plain_character(c)) == c else p for c in chars]
        if any(x is not None for x in row):
            out.append((page, row))
    return out


@lru_cache(1)
def _table() -> tuple[str, str]:
    """The pages and the places of pages, as JSON: numbers of missing pages are -1."""
    import json

    pages = _pages()
    place = {page: i for i, (page, _) in enumerate(pages)}
    return json.dumps([row for _, row in pages]), json.dumps([place.get(p, -1) for p in range(max(place) + 1)])


def normalize_latin(c: Column) -> Column:
    """The form of a text of Latin letters; other letters keep their marks."""
    return F.trim(F.regexp_replace(F.lower(F.translate(c, MARKED, PLAIN)), r"(?U)\s+", " "))


#: So many different characters of a text that become several are replaced one after the other.
_SEVERAL = 32


def normalize(c: Column) -> Column:
    """Trimmed, lower case, decomposed, without marks, with single spaces."""
    rows, places = _table()
    known, single, several = _kinds()
    pages, at = F.from_json(F.lit(rows), "array<array<string>>"), F.from_json(F.lit(places), "array<int>")

    def plain(x: Column) -> Column:
        code = F.ascii(x)
        page = F.get(at, F.shiftright(code, 8))
        return F.coalesce(F.when(page >= 0, F.get(F.get(pages, page), code.bitwiseAND(F.lit(_PAGE - 1)))), x)

    ended = F.when(F.contains(c, F.lit("Σ")), F.regexp_replace(c, _FINAL, "ς")).otherwise(c)
    characters = F.regexp_extract_all(ended, F.lit("(?s)."), 0)
    translated = F.translate(ended, known, single)  # what it gives is never one of those that become several

    def replaced(found: Column) -> Column:
        each = F.aggregate(found, translated, lambda acc, x: F.replace(acc, x["c"], x["p"]))
        return F.when(F.size(found) <= _SEVERAL, each).otherwise(F.array_join(F.transform(characters, plain), ""))

    changed = F.filter(F.transform(F.array_distinct(characters), lambda x: F.struct(x.alias("c"), plain(x).alias("p"))), lambda x: F.length(x["p"]) > 1)
    whole = F.get(F.transform(F.array(changed), replaced), F.lit(0))
    alone = ~c.rlike("[가-힣]") & (F.length(F.translate(c, several, "")) == F.length(c))
    spaced = F.trim(F.regexp_replace(F.when(alone, translated).otherwise(whole), " +", " "))
    ascii_ = F.trim(F.regexp_replace(F.lower(c), r"[\t-\r\x1c-\x20]+", " "))
    latin = c.rlike(rf"^[\t-\r\x1c-~{MARKED}]*$")
    return F.when(c.rlike(r"^[\t-\r\x1c-~]*\z"), ascii_).when(latin, normalize_latin(F.regexp_replace(c, r"[\x1c-\x1f]", " "))).otherwise(spaced)
