"""BPE encoding and decoding with a transducer lexicon of frequent words.

A text is put in the tokenizer's normal form and cut at white space; tokens never cross it. A word
is split into pieces by the tokenizer's pattern: mostly its letters and a mark behind them. The most
frequent words of all texts, lower-case and without such marks, are encoded once, in one task, and
compiled with their ids into a minimal acyclic transducer (`lexicon`), which every worker maps into
memory. A piece that it lacks is merged exactly, pair by pair in the order of rank. Bounded caches
hold what a worker met last.

Defined results: a null or empty text has no tokens and decodes to the empty text; the strings of
special tokens in a text become these tokens, as the tokenizers library has it; a very long text
is encoded whole; equal texts and repeated rows get equal tokens, row by row; an empty table gives
no rows; columns that aren't kept are ignored, and a kept one may have any name but those of the
tokens' own columns, which raise an error.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_names, small_batches, use_worker
from .lexicon import _SHIFT, _SPREAD, Lexicon, _slots, compile_lexicon

#: Words of the lexicon, and the longest of them in bytes; the driver holds so many and no more.
LEXICON_WORDS, LONGEST_WORD = 100_000, 40
#: Marks that a word is counted without where they end it.
_MARKS = ".,;:!?"
#: Words and pieces that a worker's caches hold.
CACHE_WORDS, CACHE_PIECES = 300_000, 100_000
#: Characters of text, one text more at most, that a worker encodes before it hands them on.
CHARS = 1_000_000
#: White space of the Replace and Split patterns. str.split() takes four controls more.
_BLANK = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_ODD = re.compile("[\x1c-\x1f]")


#: Letters and numbers of Unicode 16, which the tokenizers library splits by, that
#: Python's tables (15.1) lack, as inclusive ranges.
_NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
_NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]
#: Combining marks that the library's composition takes for letters: nothing is put in
#: order or composed across them.
_STARTERS = [
    (0x7FD, 0x7FD), (0x898, 0x89F), (0x8CA, 0x8D3), (0x9FE, 0x9FE), (0xC3C, 0xC3C), (0xD3B, 0xD3C), (0xEBA, 0xEBA), (0x1715, 0x1715), (0x1ABF, 0x1ACE),
    (0x1DF6, 0x1DFA), (0xA82C, 0xA82C), (0x10D24, 0x10D27), (0x10EAB, 0x10EAC), (0x10EFD, 0x10EFF), (0x10F46, 0x10F50), (0x10F82, 0x10F85),
    (0x11070, 0x11070), (0x1133B, 0x1133B), (0x1145E, 0x1145E), (0x11839, 0x1183A), (0x1193D, 0x1193E), (0x11943, 0x11943), (0x119E0, 0x119E0),
    (0x11A34, 0x11A34), (0x11A47, 0x11A47), (0x11A99, 0x11A99), (0x11D42, 0x11D42), (0x11D44, 0x11D45), (0x11D97, 0x11D97), (0x11F41, 0x11F42),
    (0x16FF0, 0x16FF1), (0x1E08F, 0x1E08F), (0x1E130, 0x1E136), (0x1E2AE, 0x1E2AE), (0x1E2EC, 0x1E2EF), (0x1E4EC, 0x1E4EF),
]
_AT_STARTERS = re.compile("([" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in _STARTERS) + "])")
#: Lower cases that Python's tables lack.
_NEW_LOWER = str.maketrans(
    {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
    | {c: c + 0x20 for c in range(0x10D50, 0x10D66)}
    | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
)
#: What needs more than NFC and lower(), beyond Latin-1; for speed, with all that is beyond U+FFFF.
_RARE = re.compile("[\u03a3" + "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in _STARTERS if b < 0x10000) + "".join(chr(c) for c in _NEW_LOWER if c < 0x10000) + "\U00010000-\U0010ffff]")


def composed(text: str) -> str:
    """NFC as the library has it."""
    try:
        text.encode("latin-1")
        return text  # Latin-1 stays as it is
    except UnicodeEncodeError:
        pass
    return "".join([unicodedata.normalize("NFC", x) for x in _AT_STARTERS.split(text)])


def _class(*kinds: str, more: list[tuple[int, int]]) -> str:
    """A character class of Unicode's general categories that start so, and of more."""
    out, start = [f"\\U{a:08x}-\\U{b:08x}" for a, b in more], None
    for c in range(sys.maxunicode + 2):
        inside = c <= sys.maxunicode and not 0xD800 <= c <= 0xDFFF and unicodedata.category(chr(c)).startswith(kinds)
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(out)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 bytes
    for themselves, the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    odd = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(odd)) for b in range(256)]


class WordBPE:
    """A byte-level BPE with word ends, lower case and dropped white space, from the JSON file of
    the tokenizers library."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = dict(map(reversed, (vocab | self.special).items()))
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.names_column = pa.array(self.names, pa.string())
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        letters = _byte_letters()
        self.inner = [vocab[x] for x in letters]
        self.last = [vocab[x + self.end] for x in letters]
        self.merges: dict[int, int] = {}  # left << 32 | right: rank << 32 | merged
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[vocab[a] << 32 | vocab[b]] = rank << 32 | vocab[a + b]
        self.no_merge = len(model["merges"]) << 32
        # the same for numpy: keys (left * number of names + right) and merges in a hash table
        pairs = np.fromiter(self.merges, np.int64, len(self.merges))
        pairs = (pairs >> 32) * len(self.names) + (pairs & 0xFFFFFFFF)
        at, size = _slots(pairs)
        self.pair_keys, self.pair_merges = np.full(size, -1), np.full(size, self.no_merge)
        self.pair_keys[at], self.pair_merges[at] = pairs, np.fromiter(self.merges.values(), np.int64, len(pairs))
        self.inner_ids, self.last_ids = np.array(self.inner), np.array(self.last)
        letter, number = _class("L", more=_NEW_LETTERS), _class("N", more=_NEW_NUMBERS)
        self.pieces = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{_BLANK}{letter}{number}]+")

    def merge(self, piece: bytes) -> list[int]:
        """Exact merges: always the pair of least rank, the leftmost of these first."""
        ids = [*map(self.inner.__getitem__, piece)]
        ids[-1] = self.last[piece[-1]]
        if len(ids) > 24:
            return self._merge_long(ids)
        get, none = self.merges.get, self.no_merge
        pairs = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while pairs and (best := min(pairs)) != none:
            at, new = pairs.index(best), best & 0xFFFFFFFF
            ids[at] = new
            del ids[at + 1], pairs[at]
            if at < len(pairs):
                pairs[at] = get(new << 32 | ids[at + 1], none)
            if at:
                pairs[at - 1] = get(ids[at - 1] << 32 | new, none)
        return ids

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge of each pair, or no_merge."""
        keys, last = left * len(self.names) + right, len(self.pair_keys) - 1
        slot = (keys * _SPREAD >> _SHIFT) & last
        met = self.pair_keys[slot]
        out = self.pair_merges[slot]
        out[met != keys] = self.no_merge
        left = np.flatnonzero((met != keys) & (met >= 0))
        slot = slot[left]
        while len(left):
            slot = slot + 1 & last
            met, want = self.pair_keys[slot], keys[left]
            hit = met == want
            out[left[hit]] = self.pair_merges[slot[hit]]
            rest = ~hit & (met >= 0)
            left, slot = left[rest], slot[rest]
        return out

    def merge_all(self, pieces: list[bytes]) -> list[np.ndarray]:
        """merge() of many pieces, those of one length together: each round merges one pair of each."""
        out, of_length = [None] * len(pieces), defaultdict(list)
        for i, p in enumerate(pieces):
            of_length[len(p)].append(i)
        for n, at in of_length.items():
            if n > 24:
                for i in at:
                    out[i] = np.array(self.merge(pieces[i]), "<u4")
                continue
            raw = np.frombuffer(b"".join([pieces[i] for i in at]), np.uint8).reshape(-1, n)
            ids, at = self.inner_ids[raw], np.array(at)
            ids[:, -1] = self.last_ids[raw[:, -1]]
            merges = self._pairs(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(at), n - 1)
            while len(at):
                row, width = np.arange(len(at)), merges.shape[1]
                best = merges.argmin(axis=1) if width else row
                going = merges[row, best] != self.no_merge if width else np.zeros(len(at), bool)
                for i, x in zip(at[~going].tolist(), ids[~going].astype("<u4")):
                    out[i] = x
                at, ids, merges, best = at[going], ids[going], merges[going], best[going]
                if not len(at):
                    break
                row = row[: len(at)]
                new = merges[row, best] & 0xFFFFFFFF
                keep = np.ones(ids.shape, bool)
                keep[row, best + 1] = False
                ids = ids[keep].reshape(len(at), width)
                ids[row, best] = new
                keep = np.ones(merges.shape, bool)
                keep[row, best] = False
                merges = merges[keep].reshape(len(at), width - 1)
                i = np.flatnonzero(best > 0)
                merges[i, best[i] - 1] = self._pairs(ids[i, best[i] - 1], new[i])
                i = np.flatnonzero(best < width - 1)
                merges[i, best[i]] = self._pairs(new[i], ids[i, best[i] + 1])
        return out

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a heap, so a piece of n bytes takes n log n steps."""
        n, get = len(ids), self.merges.get
        after, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), [False] * n
        heap = [(m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := get(ids[i] << 32 | ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            merge, i, a, b = heapq.heappop(heap)
            j, merged = after[i], merge & 0xFFFFFFFF
            if gone[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], gone[j], after[i] = merged, True, after[j]
            if after[i] < n:
                before[after[i]] = i
                if m := get(merged << 32 | ids[after[i]]):
                    heapq.heappush(heap, (m, i, merged, ids[after[i]]))
            if (k := before[i]) >= 0 and (m := get(ids[k] << 32 | merged)):
                heapq.heappush(heap, (m, k, ids[k], merged))
        return [x for x, out in zip(ids, gone) if not out]

    def normal(self, text: str) -> str:
        """The normal form of a text without special tokens."""
        if text.isascii():
            return text.lower()
        try:
            text.encode("latin-1")
            return text.lower()  # it is composed, and has nothing rare
        except UnicodeEncodeError:
            pass
        if not _RARE.search(text):
            text = unicodedata.normalize("NFC", text)
            if not _RARE.search(text):
                return text.lower()
        # letter by letter, so without a final sigma
        return composed(text).replace("Σ", "σ").translate(_NEW_LOWER).lower()

    def pieces_of(self, word: str) -> list[str]:
        """Of a word in normal form. Most are letters, or letters and one ASCII mark: these need no
        pattern."""
        if word.isalpha():
            return [word]
        if word[:-1].isalpha() and word[-1].isascii():
            return [word[:-1], word[-1]]
        return self.pieces.findall(word)

    def decode(self, ids) -> str:
        """Without a decoder in the file, the tokens' names joined by spaces."""
        return " ".join([self.names[i] for i in ids])


@lru_cache(2)
def load(spec: str) -> WordBPE:
    return WordBPE(json.loads(spec))


class _Recent(dict):
    """What make(key) gave, of the keys met last. When it is full, it becomes the older half, from
    which keys that are met again come back. Keys longer than LONGEST_WORD aren't held."""

    def __init__(self, make, most: int):
        self.make, self.most, self.older = make, most // 2, {}

    def __missing__(self, key: str):
        out = self.older.get(key)
        if out is None:
            out = self.make(key)
        self.keep(key, out)
        return out

    def keep(self, key: str, out) -> None:
        if len(key) <= LONGEST_WORD:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = out


class _Cache:
    """A tokenizer, a lexicon, and the ids of what was met last of words and pieces, as bytes: names
    would take more memory than all the rest, and are soon joined for a whole text."""

    def __init__(self, bpe: WordBPE, lexicon: Lexicon, most: int):
        self.bpe, self.lexicon = bpe, lexicon
        self.words = _Recent(self._word, most)
        self.known = _Recent(self._piece, CACHE_PIECES)

    def look_up(self, words: list[str]) -> list[bytes]:
        """Of distinct words; the pieces that neither caches nor the lexicon have are merged together."""
        out = [*map(self.words.get, words)]  # without what makes it
        new: list[tuple[int, list[str]]] = []
        fresh: dict[str, bytes] = {}
        todo: dict[str, bytes] = {}
        older, known, older_known = self.words.older, self.known, self.known.older
        for i, word in enumerate(words):
            if out[i] is not None:
                continue
            if word in older or word[0] == " ":
                out[i] = self.words[word]
                continue
            pieces = self.bpe.pieces_of(word)
            for p in pieces:
                if p in known or p in older_known or p in fresh or p in todo:
                    continue
                raw = p.encode()
                ids = self.lexicon.get(raw) if len(raw) <= LONGEST_WORD else None
                if ids is None:
                    todo[p] = raw
                else:
                    fresh[p] = _bytes(ids)
            new.append((i, pieces))
        for p, ids in zip(todo, self.bpe.merge_all([*todo.values()])):
            fresh[p] = ids.tobytes()
        for p, got in fresh.items():
            known.keep(p, got)
        for i, pieces in new:
            got = [fresh.get(p) or known[p] for p in pieces]
            out[i] = got[0] if len(got) == 1 else b"".join(got)
            self.words.keep(words[i], out[i])
        return out

    def _piece(self, piece: str) -> bytes:
        raw = piece.encode()
        ids = self.lexicon.get(raw) if len(raw) <= LONGEST_WORD else None
        return _bytes(self.bpe.merge(raw) if ids is None else ids)

    def _word(self, word: str) -> bytes:
        if word[0] == " ":  # a special token, see encode_texts()
            return _bytes([self.bpe.special[word[1:]]])
        pieces = self.bpe.pieces_of(word)
        return self.known[pieces[0]] if len(pieces) == 1 else b"".join([self.known[p] for p in pieces])


def _bytes(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


_workers: dict[int, _Cache] = {}


def _cache(spec, lexicon, most: int) -> _Cache:
    """One a process: a worker that serves another query starts anew."""

    def release():
        _workers.clear()
        load.cache_clear()

    use_worker("bpe", release)
    if id(spec) not in _workers:
        _workers.clear()
        _workers[id(spec)] = _Cache(load(spec.value), Lexicon(lexicon.value), most)
    return _workers[id(spec)]


def words_of(text: str) -> list[str]:
    return [x for x in re.split(f"[{_BLANK}]+", text) if x] if _ODD.search(text) else text.split()


def encode_text(text: str, cache: _Cache) -> tuple[bytes, str]:
    """The ids as little-endian 32-bit integers, and the decoded text."""
    bpe, word, got = cache.bpe, cache.words.__getitem__, []
    for part in bpe.special_split.split(text) if "<|" in text else (text,):
        if part in bpe.special:
            got.append(_bytes([bpe.special[part]]))
        else:
            got += map(word, words_of(bpe.normal(part)))
    raw = b"".join(got)
    return raw, bpe.decode(np.frombuffer(raw, "<u4").tolist())


def encode_texts(texts: list[str], cache: _Cache) -> tuple[pa.BinaryArray, pa.StringArray]:
    """The same of many texts, with each distinct word looked up once. A special token goes as a
    word behind a space, which no word has."""
    bpe, words, ends = cache.bpe, [], [0]
    for text in texts:
        for part in bpe.special_split.split(text) if "<|" in text else (text,):
            if part in bpe.special:
                words.append(" " + part)
            else:
                words += words_of(bpe.normal(part))
        ends.append(len(words))
    coded = pa.array(words, pa.string()).dictionary_encode()
    del words
    got = pa.array(cache.look_up(coded.dictionary.to_pylist()), pa.binary())
    raw = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), got.take(coded.indices)), pa.scalar(b"", pa.binary()))
    ids = ids_of(raw)
    names = bpe.names_column.take(ids.values)
    return raw, pc.binary_join(pa.ListArray.from_arrays(ids.offsets, names), pa.scalar(" ", pa.string()))


def ids_of(raw: pa.BinaryArray) -> pa.ListArray:
    """The ids of each text as numbers."""
    ends = np.frombuffer(raw.buffers()[1], np.int32, len(raw) + 1)
    ids = np.frombuffer(raw.buffers()[2] or b"", "<u4", ends[-1] // 4).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends // 4), pa.array(ids))


def _groups(batches, column: int):
    """The batches' rows in runs of CHARS characters, with their texts."""
    for b in batches:
        texts = [t or "" for t in b.column(column).to_pylist()]
        start = held = 0
        for i, t in enumerate(texts):
            held += len(t)
            if held >= CHARS or i == len(texts) - 1:
                yield b.slice(start, i + 1 - start), texts[start : i + 1]
                start, held = i + 1, 0


def frequent_words(docs: DataFrame, text: str = "text", most: int = LEXICON_WORDS) -> DataFrame:
    """(word): the `most` words of the highest counts, two or more, in all texts, lower-case and
    without marks at their ends; words of one count by a hash."""
    words = F.split(F.lower(F.col(text)), r"\s+")  # Java's: ASCII blanks; others stay inside words and are never found
    word = F.rtrim(F.col("word"), F.lit(_MARKS)).alias("word")
    counts = docs.select(F.explode(words).alias("word")).select(word).where((F.col("word") != "") & (F.octet_length("word") <= LONGEST_WORD))
    counts = counts.groupBy("word").count()
    return counts.where("count > 1").orderBy(F.desc("count"), F.xxhash64("word"), "word").limit(most).select("word")


def build_lexicon(bpe: WordBPE, words: list[str]) -> bytes:
    """Of the words that are one piece in normal form: the others are never looked up."""
    own = (w for w in words if bpe.normal(w) == w and words_of(w) == [w] and bpe.pieces_of(w) == [w])
    return compile_lexicon((w.encode(), bpe.merge(w.encode())) for w in own)


def _lexicon_of(words: DataFrame, spec) -> bytes:
    """Compiled in one task, from LEXICON_WORDS words at most: some MB."""

    def run(batches):
        use_worker("bpe_lexicon")
        own = [w for b in batches for w in b.column(0).to_pylist()]
        out = build_lexicon(WordBPE(json.loads(spec.value)), own)
        yield pa.RecordBatch.from_arrays([pa.array([out], pa.binary())], names=["lexicon"])

    got = words.coalesce(1).mapInArrow(run, "lexicon binary").first()
    return got[0] if got else compile_lexicon([])


def tokenize(docs: DataFrame, tokenizer_path: str, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), digests: bool = False, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """keep, n_tokens, ids array<int>, decoded of each row; with digests, SHA-256 of both in their
    place: ids_sha256, decoded_sha256. The tokenizer's file is read on the driver and broadcast
    (a file of some MB), as is the lexicon (LEXICON_WORDS words at most)."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    own = {"n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"} & {k.lower() for k in keep}
    if own:
        raise ValueError(f"kept columns are named as the tokens' own: {sorted(own)}")
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    spec_b = spark.sparkContext.broadcast(spec)
    lexicon_b = spark.sparkContext.broadcast(_lexicon_of(frequent_words(docs, text, lexicon_words), spec_b))
    tail = "n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")
    (hidden,) = free_names(list(keep), "_text")
    rows = docs.select(*keep, F.col(text).alias(hidden))
    kept = rows.drop(hidden).schema
    n_kept = len(kept)

    def run(batches):
        cache = _cache(spec_b, lexicon_b, CACHE_WORDS)
        for b, texts in _groups(batches, n_kept):
            gc.disable()  # it makes no cycles, but goes through the caches again and again
            raw, back = encode_texts(texts, cache)
            gc.enable()
            n = pc.divide(pc.binary_length(raw), 4).cast(pa.int64())
            if digests:
                out = [n, *(pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in column], pa.string()) for column in (raw, back))]
            else:
                out = [n, ids_of(raw), back]
            yield pa.RecordBatch.from_arrays([*b.columns[:n_kept], *out], names=[*(f.name for f in kept), "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))])

    from pyspark.sql.types import StructType

    return rows.mapInArrow(run, StructType([*kept, *StructType.fromDDL(tail)]))
