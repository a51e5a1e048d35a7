"""A minimal acyclic transducer that maps words to their token ids.

The words, as UTF-8, form one automaton in which equal suffixes share their states (built from
sorted words, one state at a time, after Daciuk and others). Each arc carries a number; along a
word the numbers add up to its rank among all words, and the rank names its ids. So words share
states though their outputs differ. The arcs lie in a hash table by state and byte, so a step
costs the same at every state. The whole is a few flat arrays in one buffer, which a worker writes
to an unnamed file once and maps into memory.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterable, Sequence

import numpy as np

_MAGIC = 0x7E4C2
#: The hash of an arc's key: a product, without its lowest bits.
_SPREAD, _SHIFT = 0x9E3779B1, 12


def compile_lexicon(entries: Iterable[tuple[bytes, Sequence[int]]]) -> bytes:
    """The buffer for (word, ids) with distinct words."""
    entries = sorted(entries)
    known: dict[tuple, int] = {}
    final: list[bool] = []
    arcs: list[tuple] = []  # of a closed state: ((byte, state), ...)

    def close(node: list) -> int:
        signature = (node[0], tuple(node[1]))
        state = known.get(signature)
        if state is None:
            state = known[signature] = len(final)
            final.append(node[0])
            arcs.append(signature[1])
        return state

    path: list[list] = [[False, []]]  # open states along the last word: [final, arcs]
    last = b""
    for word, _ in entries:
        common = 0
        for a, b in zip(word, last):
            if a != b:
                break
            common += 1
        while len(path) > common + 1:
            state = close(path.pop())
            path[-1][1].append((last[len(path) - 1], state))
        path.extend([False, []] for _ in range(len(word) - common))
        path[-1][0] = True
        last = word
    while len(path) > 1:
        state = close(path.pop())
        path[-1][1].append((last[len(path) - 1], state))
    root = close(path.pop())

    below = np.zeros(len(final), dtype=np.int64)  # words that end in or below a state
    keys, target, output = [], [], []
    for state, out in enumerate(arcs):  # a state's targets were closed before it
        n = int(final[state])
        for byte, to in out:
            keys.append(state << 8 | byte)
            target.append(to)
            output.append(n)
            n += below[to]
        below[state] = n
    at, size = _slots(np.asarray(keys, dtype=np.int64))
    table = [np.full(size, -1, "<i8"), np.zeros(size, "<i4"), np.zeros(size, "<i4")]
    for column, values in zip(table, (keys, target, output)):
        column[at] = values
    ids = [np.asarray(x, dtype="<u4") for _, x in entries]
    ends = np.zeros(len(ids) + 1, dtype="<i4")
    ends[1:] = np.cumsum([len(x) for x in ids]) if ids else []
    parts = [*table, np.asarray(final, "<i4"), ends, np.concatenate(ids) if ids else np.zeros(0, "<u4")]
    head = np.asarray([_MAGIC, root, *map(len, parts), 0, 0], "<i4")
    return head.tobytes() + b"".join(x.tobytes() for x in parts)


def _slots(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """A place for each of the distinct keys in a hash table at most half full: the first free one
    from its hash on. And the table's size, a power of two."""
    size = 1 << max(4, int(2 * len(keys)).bit_length())
    taken, at, left = np.zeros(size, bool), np.zeros(len(keys), np.int64), np.arange(len(keys))
    slot = (keys * _SPREAD >> _SHIFT) & (size - 1)
    while len(left):
        _, one = np.unique(slot, return_index=True)  # one key a slot
        one = one[~taken[slot[one]]]
        at[left[one]] = slot[one]
        taken[slot[one]] = True
        rest = np.ones(len(left), bool)
        rest[one] = False
        left, slot = left[rest], (slot[rest] + 1) & (size - 1)
    return at, size


class Lexicon:
    """Looks words up in a compiled buffer, mapped from an unnamed file."""

    def __init__(self, buffer: bytes):
        self._file = tempfile.TemporaryFile()  # gone with the process; only this process reads it
        self._file.write(buffer)
        self._file.flush()
        self._map = mmap.mmap(self._file.fileno(), 0, access=mmap.ACCESS_READ)
        head = np.frombuffer(self._map, "<i4", 10)
        assert head[0] == _MAGIC
        self.root, at = int(head[1]), head.nbytes
        arrays = []
        for kind, n in zip(["<i8", "<i4", "<i4", "<i4", "<i4", "<u4"], head[2:]):
            arrays.append(np.frombuffer(self._map, kind, int(n), at))
            at += arrays[-1].nbytes
        self._keys, self._target, self._output, self._final, self._ends, self._ids = map(memoryview, arrays)

    @property
    def n_states(self) -> int:
        return len(self._final)

    def __len__(self) -> int:
        return len(self._ends) - 1

    def get(self, word: bytes) -> memoryview | None:
        """The ids of a word; None where the lexicon lacks it."""
        keys, target, output = self._keys, self._target, self._output
        state, rank, last = self.root, 0, len(keys) - 1
        for byte in word:
            key = state << 8 | byte
            slot = (key * _SPREAD >> _SHIFT) & last
            while (met := keys[slot]) != key:
                if met < 0:
                    return None
                slot = slot + 1 & last
            rank += output[slot]
            state = target[slot]
        if not self._final[state]:
            return None
        return self._ids[self._ends[rank] : self._ends[rank + 1]]
