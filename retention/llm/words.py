"""Vectorised words of a block of texts.

``WordBlock`` has positions and 64-bit hashes, for candidates only: whatever they
propose is checked on the text. ``Runs`` groups equal byte strings exactly.
"""

from __future__ import annotations

import numpy as np
import xxhash

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base, and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    return h * np.uint64(0xBF58476D1CE4E5B9) ^ (h >> np.uint64(31))


class WordBlock:
    """Words of several texts, whose separators have all become spaces."""

    def __init__(self, parts: list[bytes]):
        self.text = b" ".join(parts) + b" "
        buf = np.frombuffer(self.text, np.uint8)
        inside = np.concatenate(([False], buf != 32, [False]))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edge[0::2], edge[1::2]
        bounds = np.cumsum([len(p) + 1 for p in parts])
        upto = np.searchsorted(self.starts, bounds)
        self.first = np.concatenate(([0], upto[:-1]))  # first word of each text
        self.n_words = upto - self.first
        self.doc = np.repeat(np.arange(len(parts)), self.n_words)
        up, down = powers(len(buf) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:-1])))
        self.hash = mix((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and whether they lie in one text."""
        n = max(0, len(self.hash) - k + 1)
        g = np.full(n, k, np.uint64)
        for j in range(k):
            g = g * np.uint64(0x100000001B3) + self.hash[j:n + j]
        return mix(g), self.doc[:n] == self.doc[k - 1:n + k - 1] if n else np.zeros(0, bool)

    def joined(self, at: int, k: int) -> bytes:
        return b" ".join([self.text[s:e] for s, e in zip(self.starts[at:at + k].tolist(), self.ends[at:at + k].tolist())])


#: Strings that are hashed as a whole, and masks of the first n of eight bytes.
LONG = 256
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


class Runs:
    """Groups of equal strings among ``text[start:end]``, none of which holds byte 0.

    A string of up to eight bytes is its own 64-bit key (zero padding is unambiguous),
    a longer one has a mixed key, and whether equal keys are equal strings is checked.
    ``order`` sorts the strings by group and then place, ``head`` flags a group's first.
    ``text`` ends with eight bytes that belong to no string.
    """

    def __init__(self, text: bytes, starts: np.ndarray, ends: np.ndarray, mixed=_mix):
        self.text, self.starts, self.ends, self.lens = text, starts, ends, ends - starts
        self.eight = np.ndarray(len(text) - 7, "<u8", text, strides=(1,))
        self.order, self.head = self._grouped(self._keys(mixed))
        if not self._equal():
            number: dict[bytes, int] = {}
            self.order, self.head = self._grouped(np.array([number.setdefault(self.string(i), len(number))
                                                            for i in range(len(starts))], np.uint64))

    def string(self, i: int) -> bytes:
        return self.text[self.starts[i]:self.ends[i]]

    def models(self) -> np.ndarray:
        """The first string of each group."""
        return self.order[np.flatnonzero(self.head)]

    def strings(self) -> list[bytes]:
        """The string of each group."""
        at = self.models()
        return [self.text[s:e] for s, e in zip(self.starts[at].tolist(), self.ends[at].tolist())]

    def groups(self) -> np.ndarray:
        """Number of each string's group, in the order of ``models``."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.cumsum(self.head) - 1
        return out

    def _chunk(self, at: np.ndarray, j: int) -> np.ndarray:
        return self.eight[self.starts[at] + j] & _MASK[np.minimum(self.lens[at] - j, 8)]

    def _keys(self, mixed) -> np.ndarray:
        key = self.eight[self.starts] & _MASK[np.minimum(self.lens, 8)]
        at, j = np.flatnonzero((self.lens > 8) & (self.lens <= LONG)), 8
        while len(at):
            key[at] = mixed(mixed(key[at]) + self._chunk(at, j))
            j += 8
            at = at[self.lens[at] > j]
        for i in np.flatnonzero(self.lens > LONG).tolist():
            key[i] = xxhash.xxh64_intdigest(self.string(i))
        return key

    @staticmethod
    def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(key, kind="stable")
        key = key[order]
        return order, np.concatenate((np.ones(min(len(key), 1), bool), key[1:] != key[:-1]))

    def _equal(self) -> bool:
        """Whether all strings of a key are the same bytes."""
        model = self.models()[np.cumsum(self.head) - 1]
        if not np.array_equal(self.lens[self.order], self.lens[model]):
            return False
        long = self.lens[model] > 8
        at, model, j = self.order[long], model[long], 8
        huge = self.lens[model] > LONG
        if any(self.string(a) != self.string(m) for a, m in zip(at[huge].tolist(), model[huge].tolist())):
            return False
        at, model = at[~huge], model[~huge]
        if not np.array_equal(self._chunk(at, 0), self._chunk(model, 0)):
            return False
        while len(at):
            if not np.array_equal(self._chunk(at, j), self._chunk(model, j)):
                return False
            j += 8
            more = self.lens[at] > j
            at, model = at[more], model[more]
        return True
