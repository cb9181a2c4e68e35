"""Words of many texts as 64-bit hashes, and exact caches of parts of texts (inside tasks).

A word's hash is a polynomial of its bytes modulo the prime 2**61 - 1, read off
prefix sums of a whole buffer, and mixed. Two different words of n bytes agree
for n of the 2**61 bases at most, so no pattern of bytes makes them agree (as
it does modulo a power of two). The work arrays are about 80 times the buffer,
so ``batches`` hashes CHUNK bytes at a time, cut at separators also within
one very long text.

``Known`` is keyed by the spelling itself, ``Packed`` by its bytes as a few
64-bit words, many parts at once; ``Checked`` by such hashes, with the bytes kept
beside them and compared: a part is found only by its own bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np

CHUNK = 1 << 17
PRIME = (1 << 61) - 1
_P, _M31, _M30 = np.uint64(PRIME), np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_31, _30, _61, _1 = np.uint64(31), np.uint64(30), np.uint64(61), np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo the prime."""
    x = (x & _P) + (x >> _61)
    return np.where(x >= _P, x - _P, x)


def _product(a1: np.ndarray, a0: np.ndarray, b1: np.ndarray, b0: np.ndarray) -> np.ndarray:
    """(a1 2**31 + a0) (b1 2**31 + b0) modulo the prime; halves of numbers below it."""
    middle = a0 * b1 + a1 * b0
    return _reduced(((a1 * b1) << _1) + (middle >> _30) + ((middle & _M30) << _31) + a0 * b0)


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x >> _31, x & _M31


#: The base, and the value of each byte from a sequence of this seed.
_BASE = 0x1E3779B97F4A7C15 % PRIME
_values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7)) % _P
_high, _low = _halves(_values)
_lower = np.arange(256)
_lower[65:91] += 32
_space = np.zeros(256, dtype=bool)
_space[[9, 10, 11, 12, 13, 32]] = True
_other = np.array([not (chr(b).isalnum() or b >= 128) for b in range(256)])

#: Name of a word rule: (bytes between words, the two halves of each byte's value).
RULES = {"spaces, A-Z lowered": (_space, *_halves(_values[_lower])), "letters and digits, A-Z lowered": (_other, *_halves(_values[_lower]))}

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Halves of the first n powers of a base."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        x = np.ones(1, dtype=np.uint64)
        while len(x) < max(n, CHUNK + 1):
            by = pow(base, len(x), PRIME)
            x = np.concatenate([x, _product(*_halves(x), np.uint64(by >> 31), np.uint64(by & ((1 << 31) - 1)))])
        have = _powers[base] = _halves(x)
    return have[0][:n], have[1][:n]


def hash_spans(high: np.ndarray, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span of a buffer of values (their halves)."""
    term = _product(high, low, *_power(_BASE, len(high)))
    sums = []
    for half in _halves(term):  # sums of halves stay below 2**64, so spans are differences of them
        total = np.zeros(len(high) + 1, dtype=np.uint64)
        np.cumsum(half, out=total[1:])
        sums.append(_reduced(total[end] - total[start]))
    turned = ((sums[0] << _31) & _P) | (sums[0] >> _30)  # times 2**31
    down = _power(pow(_BASE, -1, PRIME), len(high) + 1)
    h = _product(*_halves(_reduced(turned + sums[1])), down[0][start], down[1][start])
    return mix(h + ((end - start).astype(np.uint64) << np.uint64(40)))


def hash_words(data: bytes, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(byte position of each word, its hash) in a buffer."""
    gap, high, low = RULES[rule]
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = ~gap[raw]
    step = np.diff(inside)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    return start, hash_spans(high[raw], low[raw], start, end)


def batches(texts: Iterable[bytes | None], rule: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, words per text, hashes) for runs of whole texts.

    Null counts as empty. A text over CHUNK bytes comes alone, hashed in
    pieces cut at separators.
    """
    gap = RULES[rule][0]
    held: list[bytes] = []
    first = size = 0

    def flush():
        ends = np.cumsum([len(t) + 1 for t in held])
        start, h = hash_words(b"\n".join(held), rule)
        return first, np.diff(np.searchsorted(start, ends), prepend=0), h

    for i, t in enumerate(texts):
        t = t or b""
        if held and size + len(t) > CHUNK:
            yield flush()
            held, size, first = [], 0, i
        if len(t) > CHUNK:
            parts, at = [], 0
            while at < len(t):
                end = min(at + CHUNK, len(t))
                while end < len(t) and not gap[t[end]]:
                    end += 1
                parts.append(hash_words(t[at:end], rule)[1])
                at = end
            h = np.concatenate(parts)
            yield i, np.array([len(h)]), h
            first = i + 1
            continue
        held.append(t)
        size += len(t) + 1
    if held:
        yield flush()


def _spans(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all spans end to end."""
    upto = np.cumsum(size)
    n = int(upto[-1]) if len(upto) else 0
    kind = np.int32 if n < 1 << 30 and (not len(at) or int(at.max()) < 1 << 30) else np.int64
    out = np.repeat((at - upto + size).astype(kind), size)
    out += np.arange(n, dtype=kind)
    return out


def _keys(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the parts of a large buffer, about CHUNK bytes at a time."""
    cuts = np.unique(np.append(np.searchsorted(start, np.arange(0, len(raw), CHUNK)), len(start))).tolist()
    out = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        own = raw[start[a]:end[b - 1]]
        out.append(hash_spans(_high[own], _low[own], start[a:b] - start[a], end[a:b] - start[a]))
    return np.concatenate(out)


class Checked:
    """Parts of byte buffers with a run of small integers each, by hash and bytes; starts anew at ``limit`` entries or ``limit_size`` bytes."""

    def __init__(self, kind: type, limit: int, limit_size: int):
        self.kind, self.limit, self.limit_size = kind, limit, limit_size
        self.forget()

    def forget(self) -> None:
        self.keys, self.row = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)  # sorted hashes, their rows
        self.n = 0
        self.text_at, self.text_size, self.at, self.size = (np.zeros(1024, dtype=np.int64) for _ in range(4))
        self.text, self.text_used = np.zeros(1 << 16, dtype=np.uint8), 0
        self.flat, self.used = np.zeros(1 << 16, dtype=self.kind), 0

    def rows(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray, make: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> np.ndarray | None:
        """The row of each part raw[start:end]; ``make`` gives new parts' runs
        end to end and their sizes. None if two parts have one hash."""
        size = end - start
        keys, one, back = np.unique(_keys(raw, start, end), return_index=True, return_inverse=True)
        # every part against the first of its hash here
        first = one[back]
        own = raw[start[0]:end[-1]] if (start[1:] == end[:-1]).all() else raw[_spans(start, size)]
        if (size != size[first]).any() or (raw[_spans(start[first], size)] != own).any():
            return None
        if self.n + len(keys) > self.limit or self.text_used + int(size[one].sum()) > self.limit_size:
            self.forget()
        place = np.searchsorted(self.keys, keys)
        there = np.zeros(len(keys), dtype=bool)
        inside = place < len(self.keys)
        there[inside] = self.keys[place[inside]] == keys[inside]
        # and that one against what is kept
        had, here = self.row[place[there]], one[there]
        if (self.text_size[had] != size[here]).any() or (self.text[_spans(self.text_at[had], size[here])] != raw[_spans(start[here], size[here])]).any():
            return None
        if not there.all():
            new = one[~there]
            runs, sizes = make(start[new], end[new])
            rows = self._add(raw[_spans(start[new], size[new])], size[new], runs, sizes)
            self.keys = np.insert(self.keys, place[~there], keys[~there])
            self.row = np.insert(self.row, place[~there], rows)
            place = np.searchsorted(self.keys, keys)
        return self.row[place][back]

    def _add(self, text: np.ndarray, text_sizes: np.ndarray, runs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        while self.used + len(runs) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.text_used + len(text) > len(self.text):
            self.text = np.concatenate([self.text, np.zeros_like(self.text)])
        a, b = self.n, self.n + len(sizes)
        while b > len(self.at):
            self.text_at, self.text_size, self.at, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.text_at, self.text_size, self.at, self.size))
        self.flat[self.used:self.used + len(runs)] = runs
        self.text[self.text_used:self.text_used + len(text)] = text
        self.at[a:b], self.size[a:b] = self.used + np.cumsum(sizes) - sizes, sizes
        self.text_at[a:b], self.text_size[a:b] = self.text_used + np.cumsum(text_sizes) - text_sizes, text_sizes
        self.used, self.text_used, self.n = self.used + len(runs), self.text_used + len(text), b
        return np.arange(a, b)

    def runs(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the runs of these rows end to end, where each ends)."""
        size = self.size[rows]
        return self.flat[_spans(self.at[rows], size)], np.cumsum(size)


class Known:
    """Spellings with a run of small integers each, and ``extra`` numbers; starts anew at ``limit`` entries or ``limit_size`` characters."""

    def __init__(self, kind: type, limit: int, limit_size: int, extra: int = 0):
        self.kind, self.limit, self.limit_size, self.extra = kind, limit, limit_size, extra
        self.forget()

    def forget(self) -> None:
        self.row: dict = {}
        self.held = self.n = 0
        self.at, self.size = np.zeros(1024, dtype=np.int64), np.zeros(1024, dtype=np.int32)
        self.more = np.zeros((1024, self.extra))
        self.flat, self.used = np.zeros(1 << 16, dtype=self.kind), 0

    def rows(self, parts: list, make: Callable[[list], tuple[np.ndarray, np.ndarray, np.ndarray | None]]) -> np.ndarray:
        """The row of each part; ``make`` gives new parts' runs end to end, their sizes and extra numbers."""
        found = list(map(self.row.get, parts))
        if None in found:
            new = list(dict.fromkeys(p for p, r in zip(parts, found, strict=True) if r is None))
            longer = sum(map(len, new))
            if self.n + len(new) > self.limit or self.held + longer > self.limit_size:
                self.forget()
                new = list(dict.fromkeys(parts))
                longer = sum(map(len, new))
                found = [None] * len(parts)
            a = self._add(*make(new))
            self.row.update(zip(new, range(a, self.n), strict=True))
            self.held += longer
            found = [self.row[p] if r is None else r for p, r in zip(parts, found, strict=True)]
        return np.array(found, dtype=np.int64)

    def _add(self, runs: np.ndarray, sizes: np.ndarray, more: np.ndarray | None) -> int:
        """The first of the rows added."""
        while self.used + len(runs) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        a, b = self.n, self.n + len(sizes)
        while b > len(self.at):
            self.at, self.size, self.more = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.size, self.more))
        self.flat[self.used:self.used + len(runs)] = runs
        self.at[a:b] = self.used + np.cumsum(sizes) - sizes
        self.size[a:b] = sizes
        if self.extra:
            self.more[a:b] = more
        self.used, self.n = self.used + len(runs), b
        return a

    def runs(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the runs of these rows end to end, where each ends)."""
        size = self.size[rows].astype(np.int64)
        upto = np.cumsum(size)
        if not len(rows):
            return self.flat[:0], upto
        return self.flat[np.repeat(self.at[rows] - upto + size, size) + np.arange(upto[-1])], upto


WORDS = 4
#: The bytes of a little-endian word that belong to a part with 0 to 8 bytes from its start on.
_masks = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


class Packed(Known):
    """The same for parts of a byte buffer. Those of up to 8 * WORDS bytes are found
    in a table with open addresses by their bytes as WORDS words and their length,
    all at once; longer ones in the dictionary."""

    def forget(self) -> None:
        super().forget()
        self.table = np.full(1 << 12, -1, dtype=np.int32)
        self.words, self.length = [np.zeros(1024, dtype=np.uint64) for _ in range(WORDS)], np.zeros(1024, dtype=np.int64)

    def spans(self, data: bytes, start: np.ndarray, end: np.ndarray, make: Callable[[list], tuple[np.ndarray, np.ndarray, np.ndarray | None]]) -> np.ndarray:
        """The row of each part data[start:end]; ``make`` gets the bytes of new parts."""
        size = end - start
        padded = data + bytes(8 * WORDS)
        view = np.ndarray(len(data) + 1 + 8 * (WORDS - 1), dtype="<u8", buffer=padded, strides=(1,))
        words = [view[start + 8 * k if k else start] & _masks[np.clip(size - 8 * k, 0, 8)] for k in range(WORDS)]
        found = self._find(words, size)
        longer = np.flatnonzero(size > 8 * WORDS)
        found[longer] = [self.row.get(data[i:j], -1) for i, j in zip(start[longer].tolist(), end[longer].tolist(), strict=True)]
        new, more = self._new(data, start, end, np.flatnonzero(found < 0))
        if self.n + len(new) > self.limit or self.held + more > self.limit_size:
            self.forget()
            found[:] = -1
            new, more = self._new(data, start, end, np.arange(len(start)))
        if new:
            a = self._add(*make(list(new)))
            self.held += more
            one = np.fromiter(new.values(), dtype=np.int64, count=len(new))
            self._keep(a, [w[one] for w in words], size[one])
            rows = dict(zip(new, range(a, self.n), strict=True))
            self.row.update((p, r) for p, r in rows.items() if len(p) > 8 * WORDS)
            missing = np.flatnonzero(found < 0)
            found[missing] = [rows[data[i:j]] for i, j in zip(start[missing].tolist(), end[missing].tolist(), strict=True)]
        return found

    def _new(self, data: bytes, start: np.ndarray, end: np.ndarray, missing: np.ndarray) -> tuple[dict[bytes, int], int]:
        """(the different ones of the missing parts, each with one of its places; their bytes)."""
        new = {data[i:j]: k for i, j, k in zip(start[missing].tolist(), end[missing].tolist(), missing.tolist(), strict=True)}
        return new, sum(map(len, new))

    def _path(self, words: list[np.ndarray], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first place in the table, distance to the next ones) of each part."""
        h = size.astype(np.uint64)
        for w in words:
            h = (h ^ w) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        last = len(self.table) - 1
        return (h & np.uint64(last)).astype(np.int64), ((h >> np.uint64(40)) & np.uint64(last)).astype(np.int64) | 1

    def _find(self, words: list[np.ndarray], size: np.ndarray) -> np.ndarray:
        rows = np.full(len(size), -1, dtype=np.int64)
        at, step = self._path(words, size)
        left = np.arange(len(size))
        while len(left):
            row = self.table[at]
            there = row >= 0
            if not there.all():
                left, row, at, step = left[there], row[there], at[there], step[there]
            same = self.length[row] == size[left]
            for kept, own in zip(self.words, words, strict=True):
                same &= kept[row] == own[left]
            rows[left[same]] = row[same]
            left, at, step = left[~same], at[~same], step[~same]
            at = (at + step) & (len(self.table) - 1)
        return rows

    def _keep(self, a: int, words: list[np.ndarray], size: np.ndarray) -> None:
        """Puts the rows from a on into the table; those too long for it stay out."""
        while self.n > len(self.length):
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
            self.words = [np.concatenate([w, np.zeros_like(w)]) for w in self.words]
        self.length[a:self.n] = size
        for kept, own in zip(self.words, words, strict=True):
            kept[a:self.n] = own
        if 2 * self.n > len(self.table):
            self.table = np.full(1 << (4 * self.n).bit_length(), -1, dtype=np.int32)
            a = 0
        row = a + np.flatnonzero(self.length[a:self.n] <= 8 * WORDS)
        at, step = self._path([w[row] for w in self.words], self.length[row])
        while len(row):
            free = self.table[at] < 0
            self.table[at[free]] = row[free]  # of several on one place, one stays
            left = self.table[at] != row
            row, at, step = row[left], at[left], step[left]
            at = (at + step) & (len(self.table) - 1)
